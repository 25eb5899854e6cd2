"""The literal cases of the scalar functions."""

import collections
import itertools

import pytest
from pyspark.sql import functions as F

from noticeweave.functions import address, dates, numbers, rules, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("3 en 9", [("3", ""), ("9", "")]), ("3 & 9", [("3", ""), ("9", "")]), ("7, 9a en 11", [("7", ""), ("9", "A"), ("11", "")]), ("7-11", [("7", ""), ("11", "")]),
        ("27-27A", [("27", ""), ("27", "A")]), ("7-9-11", [("7", ""), ("9", ""), ("11", "")]), ("27-27A-29", [("27", ""), ("27", "A"), ("29", "")]),
        ("9 t/m 7", [("7", ""), ("8", ""), ("9", "")]), ("7", []), ("7a", []), ("", []), (None, []), ("7, 9", []), ("7-7-9", [("7", ""), ("7", ""), ("9", "")]),
        ("7a-9", [("7", "A"), ("9", "")]), ("7a en 9", []), ("7, 9 en x", []), ("7-9-x", []), ("7ab-9", []), ("1 t/m 1500", [(str(n), "") for n in range(1, 1501)]), ("7, 9-11 en 13", []),
        ("99999999999 en 3", [("99999999999", ""), ("3", "")]), ("7\u20139", [("7", ""), ("9", "")]), ("7 en", []),
    ],
)
def test_house_numbers(spark, raw, expected):
    assert list(numbers.several_numbers(raw)) == expected
    rows = numbers.expanded(spark.createDataFrame([(raw, "own")], "nr string, suffix string"), "nr", "nr", "suffix").collect()
    assert collections.Counter(map(tuple, rows)) == collections.Counter(expected or [(raw, "own")])


def test_house_numbers_come_one_by_one():
    assert list(itertools.islice(numbers.several_numbers("1 t/m 99999999999"), 3)) == [("1", ""), ("2", ""), ("3", "")]


def test_keys(spark):
    lit = F.lit
    assert value(spark, address.address_key(lit(" Één-weg"), lit("7"), lit("A"), lit("1234 AB"), lit("'s-Plaats"))) == "een weg|7|a|1234 ab|s plaats"
    assert value(spark, address.address_key(lit("weg"), lit(""), lit("A"), lit("1234 AB"), lit("Plaats"))) == ""
    assert value(spark, address.match_key(lit("Één-weg"), lit("7a"), lit(""), lit("1234 ab"), lit("Plaats"))) == "een weg|7|a|1234AB|plaats"


def test_variants(spark):
    lit = F.lit
    assert set(value(spark, address.street_variants(lit("Kerkstraat")))) == {"kerkstraat"}
    assert set(value(spark, address.street_variants(lit("Oude weg")))) == {"oude weg", "oude wg"}
    assert set(value(spark, address.street_variants(lit("dr Testlaan")))) == {"dr testlaan", "testlaan"}
    assert set(value(spark, address.place_variants(lit("St Test gld")))) == {"st test", "sint test", "st"}
    assert set(value(spark, address.place_variants(lit("Test aan de Veen")))) == {"test aan de veen", "test aan de ", "test", "test veen", "test aan de"}
    assert value(spark, address.street_variants(lit("weg naar de laan"))) == ["weg naar de laan", "weg naar de ln"]
    assert value(spark, address.street_variants(lit("Ysselweg"))) == ["ijsselweg"] and value(spark, address.street_variants(lit(None).cast("string"))) == [""]
    assert value(spark, address.variant_keys(*[lit("")] * 5)) == []
    assert set(value(spark, address.all_variant_keys(lit("oude weg|7|a|1234ab|plaats,, x")))) == {"oude weg|7|a|1234AB|plaats", "oude wg|7|a|1234AB|plaats", "x||||"}
    assert value(spark, address.place_variants(lit("gr"))) == []
    assert value(spark, address.place_variants(lit(""))) == [""]


def test_normalisers(spark):
    lit = F.lit
    assert value(spark, text.postcode(lit("1234ab"))) == "1234 AB"
    assert value(spark, text.postcode(lit("12345"))) == ""
    assert value(spark, text.register_number(lit("0123.0"))) == "123"
    assert value(spark, text.clean_text(lit("Één-weg!"))) == "een weg"
    assert value(spark, text.clean_missing(lit(" NaN "))) == ""
    assert value(spark, text.title_tokens(lit("oude kerkWeg"))) == "Oude KerkWeg"
    assert value(spark, text.thousands(lit(1234567))) == "1.234.567"
    assert value(spark, text.html_text(lit("<p>a <b>b</b></p><script>x</script>&amp; c"))) == "a b & c"
    assert value(spark, text.keyword_in_context(lit("a b c d e f lbv g h i j k l m"), "lbv")) == "b c d e f lbv g h i j k"
    assert value(spark, text.evidence_sentence(lit("Eerst dit. Dan de lbv hier; en meer"), "lbv")) == "Dan de lbv hier;"


def test_dates(spark):
    lit = F.lit
    assert value(spark, dates.day_month_year(lit("2025-03-05T10:00:00Z"))) == "05-03-2025"
    assert value(spark, dates.day_month_year(lit("05/03/2025"))) == "05-03-2025"
    assert value(spark, dates.day_month_year(lit("n/a"))) == "n/a"
    assert value(spark, dates.irrevocable(lit("definitive_decision"), lit("2025-01-01").cast("date"), "2025-03-01")) is True


def test_rules(spark):
    lit = F.lit
    for given, expected in (("LBV of LBV+", "ambiguous"), ("Lbv-plus", "lbv_plus"), ("lbv regeling", "lbv"), ("niets", "unknown")):
        assert value(spark, rules.scheme(lit(given))) == expected
    assert value(spark, rules.classify(lit("aanvraag ontvangen LBV")))["stage"] == "receipt_of_application"
    assert value(spark, rules.override_stage(lit("definitive_decision"), lit("het ontwerpbesluit ligt ter inzage"))) == "draft_decision"
    assert value(spark, rules.override_stage(lit("draft_decision"), lit("het besluit is ten opzichte van het ontwerpbesluit gewijzigd"))) == "definitive_decision"
    assert value(spark, rules.resolved_scheme(F.array(lit("ambiguous"), lit("lbv")))) == "lbv"
    assert value(spark, rules.resolved_scheme(F.array(lit("lbv"), lit("lbv_plus")))) == "lbv_plus"
    for code, category in (("A4.1", "vleeskalveren"), ("A1", "rundvee (excl. kalveren)"), ("D1", "varkens"), ("E2", "kippen"), ("F1", "kalkoenen"), ("C1", "geiten"), ("B1", ""), ("", "")):
        assert value(spark, rules.housing_category(lit(code))) == category


def test_long_texts_without_stops_take_no_longer(spark):
    long = F.concat(F.repeat(F.lit("x"), F.lit(300_000)), F.lit(" lbv "), F.repeat(F.lit("y"), F.lit(300_000)))
    assert len(value(spark, text.evidence_sentence(long, "lbv"))) == 600_005 and len(value(spark, text.keyword_in_context(long, "lbv"))) == 600_005
    assert value(spark, text.evidence_sentence(F.repeat(F.lit("x"), F.lit(300_000)), "lbv")) == "" == value(spark, text.keyword_in_context(F.lit(None).cast("string"), "lbv"))


def test_stage_rules(spark):
    lit = F.lit
    for given, draft, intent, after in (
        ("het ontwerpbesluit", True, False, False), ("het ontwerpbesluit heeft ter inzage gelegen", False, False, False), ("een ontwerpbeschikking", False, True, False),
        ("het voornemen de vergunning te verlenen", False, True, False), ("het besluit is gewijzigd sinds het ontwerpbesluit", True, False, True), ("beschikking t.o.v. de ontwerpbeschikking gewijzigd", False, True, True), ("", False, False, False), (None, False, False, False),
    ):
        c = lit(given).cast("string")
        assert (value(spark, rules.current_draft(c)), value(spark, rules.draft_intent(c)), value(spark, rules.after_draft(c))) == (draft, intent, after), given
    found = value(spark, rules.scheme_evidence(lit("De LBV regeling is open. Dit betreft piekbelasting hier.")))
    assert found["sentence"] == "Dit betreft piekbelasting hier."
    assert value(spark, rules.scheme(lit("lbv en lbv+"))) == "lbv_plus" and value(spark, rules.guard(lit(None).cast("string"), ["a"], "z")) == "z"


@pytest.mark.parametrize(
    ("title", "expected"),
    [
        ("Natuurvergunning - Oude Kerkweg 12a, Ons Dorp", ("Oude Kerkweg", "12", "a", "", "Ons Dorp")), ("Besluit, Dorpsstraat 5, 1234 ab te Plaats", ("Dorpsstraat", "5", "", "1234 AB", "Plaats")),
        ("locatie kerkpad 3 te Dorp", ("Kerkpad", "3", "", "", "Dorp")), ("zonder adres", None), ("", None), (None, None),
    ],
)
def test_title_addresses(spark, title, expected):
    found = value(spark, address.title_address(F.lit(title).cast("string")))
    assert (found and tuple(found)[:5]) == expected


def test_names_and_fills(spark):
    lit = F.lit
    assert value(spark, text.joined_once(F.array(lit("Ab"), lit(None).cast("string"), lit(" aB "), lit("c")))) == "Ab | c"
    assert value(spark, text.province(lit(" Provincie Noord-Brabant"))) == "noord-brabant" == value(spark, text.province(lit("Brabant")))
    assert value(spark, text.company_name(lit("x Bedrijf:  De  Hoeve. Locatie: y"))) == "De Hoeve" and value(spark, text.company_name(lit(None).cast("string"))) == ""
    assert value(spark, text.file_name(lit("https://x/a%zz b"))) == "a_zz_b.pdf" and value(spark, text.file_name(lit("https://x/a%20b.pdf"))) == "a_b.pdf"
    assert value(spark, text.absolute_url(lit("/a"), "https://x/")) == "https://x/a" and value(spark, text.absolute_url(lit(None).cast("string"), "https://x")) == ""
    assert [value(spark, text.positive(lit(x).cast("string"))) for x in ("1.5", "0", "-1", "x", None)] == [True, False, False, False, False]
    assert value(spark, text.kept_company(lit(""), lit("bedrijf: A locatie: b"), lit("Provincie Noord-Brabant"))) == "A" and value(spark, text.kept_company(lit("B"), lit(""), lit("Limburg"))) == ""
    assert [value(spark, c) for c in address.split_suffix(lit("7a"), lit(""))] == ["7", "a"] and [value(spark, c) for c in address.split_suffix(lit("7a"), lit("b"))] == ["7a", "b"]
    assert value(spark, address.register_key(lit("Weg"), lit("7"), lit("1234ab"), lit("Dorp gld"))) == "weg|7||1234AB|dorp"
    assert value(spark, address.lookup_query(lit("7"), lit("a"), lit("1234 ab"))) == "1234AB 7a" and value(spark, address.lookup_query(None, None, None, lit("N"), lit(""))) == "N"
    assert value(spark, text.housing_text_category(lit(""), lit("Huisvesting Kippen"))) == "kippen" and value(spark, text.housing_text_category(lit("A4.2"), lit(""))) == "vleeskalveren"
    assert value(spark, text.housing_text_category(lit("a4"), lit("kalkoe"))) == "kalkoenen" and value(spark, text.housing_text_category(lit(" A1"), lit("x"))) == "rundvee (excl. kalveren)"


def test_names_as_in_the_registers(spark):
    lit = F.lit
    assert value(spark, text.name_key(lit("Vennootschap onder Firma de Bruin, Melkvee van Één"))) == "bruin de een van"
    assert value(spark, text.name_key(lit("De B.V. Holding"))) == "b de v" and value(spark, text.name_key(lit(None).cast("string"))) == ""
    assert value(spark, text.plain_name(lit('Stichting "Één"-[Hof] V.O.F. mts'))) == "één hof v o f" and value(spark, text.plain_name(lit(None).cast("string"))) == ""
    assert [value(spark, text.register_number(lit(x))) for x in ("00123.0", "12.00", " KVK 01", "0.0", "1.5")] == ["123", "12.00", "KVK 01", "", "1.5"]
    for given, name in (("Zuidholland", "zuid-holland"), ("Z.Holland", "zuid-holland"), ("Noord_Holland", "noord-holland"), ("fryslân", "friesland"), ("West-Brabant", "west brabant"), ("", "")):
        assert value(spark, text.province(lit(given))) == name
    assert value(spark, text.slug(lit("Noord Brabant"))) == "noord-brabant" and value(spark, text.slug(lit("a-b c/d"))) == "a_b_c_d"
    for given, name in (("https://x/a.pdf?x=1", "a.pdf"), ("https://x", "download.pdf"), ("https://x/a/", "a.pdf"), ("https://x/%2e%2E", "download.pdf"), ("https://x/a%2Fb;v=1", "a_b.pdf")):
        assert value(spark, text.file_name(lit(given))) == name, given
    long = "x" * 500
    assert value(spark, text.company_name(lit(f"Bedrijf - {long} - locatie - y"))) == long and value(spark, text.company_name(lit("bedrijf: X"))) == ""
    assert len(value(spark, text.title_tokens(F.repeat(lit("a"), lit(1_000_005))))) == 1_000_005
    for given, stage in (("Natura 2000: de ontwerpbeschikking volgt", "other"), ("natura 2000, nadere besluitvorming", "other"), ("natura 2000 het besluit", "definitive_decision"), ("de albv en het besluit", "other"), ("natura 2000: voornemens", "intent_notice")):
        assert value(spark, rules.classify(lit(given)))["stage"] == stage, given
