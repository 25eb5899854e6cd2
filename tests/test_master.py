"""The master table, totals and predicates on nulls, blanks, ties, repeats and empty tables."""

from pyspark.sql import functions as F

from noticeweave.functions import dates
from noticeweave.operators import identity, master, matching, merge, metrics, records, repair


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_totals_agree_within_a_band_and_zero_or_unknown_ones_say_nothing(spark):
    df = spark.createDataFrame([(1.0, 1.9), (1.0, 2.1), (0.0, 5.0), (5.0, 0.0), (None, 1.0), (4.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(matching.plausible("a", "b")).collect()] == [True, False, True, True, True, True]


def test_years_of_either_column_or_of_none(spark):
    df = spark.createDataFrame([("2021", None), (None, "2021"), (None, None), ("2020", "2020"), ("x", ""), ("2020", "2021")], "a string, b string")
    assert [r[0] for r in df.select(dates.within_year(["a", "b"], 2021)).collect()] == [True, True, True, False, True, True]
    assert [r[0] for r in df.select(dates.within_year(["a"], 2021, undated=False)).collect()] == [True, False, False, False, False, False]


def test_master_rows_link_by_the_first_stage_and_share_relations(spark):
    own = spark.createDataFrame([("p1", "F1", "x"), ("p2", "F2", "x"), ("p3", "F0", "x")], "key string, farm string, title string")
    theirs = spark.createDataFrame([("m1", "F8"), ("m2", "F9"), ("m3", "F7")], "key string, farm string")
    pairs = lambda *p: spark.createDataFrame(list(p), "key string, rel string")
    found = master.master_rows(own, [("adres", pairs(("p1", "r1"), ("p1", "r1"), ("p1", "r2"))), ("naam", pairs(("p1", "r9"), ("p3", "r1")))], theirs, [("kvk", pairs(("m1", "r1"), ("m2", "r5")))], "key", "farm", "rel")
    got = rows(master.with_derived(found, ["key", "farm", "rel", "link_method", "title", "other"]).select("key", "farm", "rel", "link_method", "title", "other"))
    assert got == sorted([("p1", "F1", "r1", "adres", "x", None), ("p1", "F1", "r2", "adres", "x", None), ("p2", "F2", None, "niet_gelinkt", "x", None), ("p3", "F0", "r1", "naam", "x", None), ("m1", "F1", "r1", "linked_via_rel", None, None), ("m2", "F9", "r5", "kvk", None, None), ("m3", "F7", None, "niet_gelinkt", None, None)], key=repr)
    none = master.master_rows(own.limit(0), [("adres", pairs(("p1", "r1")))], theirs.limit(0), [("kvk", pairs(("m1", "r1")))], "key", "farm", "rel")
    assert none.count() == 0


def test_relations_counts_and_folded_notices(spark):
    linked = spark.createDataFrame([("F1", "r1", "adres"), ("F1", "r1", "naam"), ("F2", "r2", "niet_gelinkt"), ("F3", None, "adres"), (None, "r4", "adres"), ("F5", "r5", "adres")], "farm string, rel string, link_method string")
    relations = master.farm_relations(linked, "farm", "rel")
    assert rows(relations) == [("F1", "r1"), ("F5", "r5")]
    counts = spark.createDataFrame([("r1", 0), ("r1", 3), ("r5", None), ("r5", -1)], "rel string, n int")
    assert rows(master.with_any_count(relations, counts, "farm", "rel", "n")) == [("F1",)]
    entities = spark.createDataFrame([(1, "b, a,z ,b"), (2, None), (3, "")], "farm int, docs string")
    notices = spark.createDataFrame([("a", "draft"), ("b", "final"), ("c", None)], "doc string, label string")
    assert rows(master.folded_notices(entities, "farm", "docs", notices, "doc", "label")) == [(1, 3, "final | draft | final"), (2, 0, ""), (3, 0, "")]


def test_scores_and_outside_totals(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, None), (None, "a")], "x string, y string")
    assert rows(metrics.scores(df, "x", "y")) == [(4, 2, 0.5)] and rows(metrics.scores(df.limit(0), "x", "y")) == [(0, 0, 0.0)]
    totals, own = spark.createDataFrame([("a", 10), ("b", 0), ("c", 4)], "k string, outside long"), spark.createDataFrame([("a", 5), ("b", 2)], "k string, n long")
    assert rows(metrics.against_totals(totals, own, "k", "outside", "n")) == [("a", 10, 5, 50.0), ("b", 0, 2, 0.0), ("c", 4, 0, 0.0)]


def test_state_of_identifiers_keeps_the_first_run(spark):
    groups = spark.createDataFrame([("d1", "d1"), ("d2", "d1"), ("d3", "d3")], "member string, root string")
    known = spark.createDataFrame([("d2", "FARMOLD", "2023-05-01"), ("gone", "FARMX", "2023-05-01")], "member string, stable_id string, created_at string")
    ids = identity.stable_ids(groups, known, "member", "root")
    state = {r["member"]: (r["stable_id"], r["created_at"]) for r in identity.identifier_map(groups, ids, known, "member", "root", "2024-01-01").collect()}
    assert state["d1"] == ("FARMOLD", "2024-01-01") and state["d2"] == ("FARMOLD", "2023-05-01") and state["d3"][1] == "2024-01-01" and set(state) == {"d1", "d2", "d3"}


def test_standard_columns_take_what_is_filled(spark):
    df = spark.createDataFrame([(" ", "b"), ("a", "b"), (None, None)], "x string, y string")
    assert [tuple(r) for r in merge.first_columns(df, {"name": ["none", "x", "y"], "other": ["z"]}).collect()] == [("b", ""), ("a", ""), ("", "")]
    try:
        merge.require(df, ["x", "q"])
    except ValueError as wrong:
        assert "q" in str(wrong)
    else:
        raise AssertionError


def test_addresses_are_repaired_from_titles_where_they_are_doubtful(spark):
    title = "Besluit, Dorpsstraat 5, 1234 ab te Plaats"
    given = [("Kerkweg", "7", "", "", "Elders"), ("Kerkweg", None, "", "", "Elders"), ("Kerkweg", "7", "", "", "Elders"), ("dorpsstraat", "5", "", "1234 AB", "plaats"), ("nan", "", "", "", "")]
    docs = [(i, title if i != 5 else None, "x Kerkweg 7 te Elders" if i == 2 else None, *g) for i, g in enumerate([*given, given[0]])]
    df = spark.createDataFrame(docs, "id int, title string, body string, a string, b string, c string, d string, e string")
    names = dict(zip(repair.PARTS, "abcde"))
    own = ("Dorpsstraat", "5", "", "1234 AB", "Plaats")
    repairs = repair.address_repairs(df, "id", "title", "body", names)
    assert rows(repairs) == [(0, *own, 0.95), (1, *own, 0.95), (4, *own, 0.95)]
    fixed = {r.id: (r.a, r.b, r.e) for r in repair.repaired(df, repairs, "id").collect()}
    assert fixed == {0: ("Dorpsstraat", "5", "Plaats"), 1: ("Dorpsstraat", "5", "Plaats"), 2: ("Kerkweg", "7", "Elders"), 3: ("dorpsstraat", "5", "plaats"), 4: ("Dorpsstraat", "5", "Plaats"), 5: ("Kerkweg", "7", "Elders")}
    audit = {r.id: (r.given_street, r.title_street, r.chosen_street) for r in repair.address_mismatches(df, "title", "body", names, ["id"]).collect()}
    assert audit == {"0": ("Kerkweg", "Dorpsstraat", "Dorpsstraat"), "2": ("Kerkweg", "Dorpsstraat", "Kerkweg")}
    assert repair.address_repairs(df.limit(0), "id", "title", "body", names).count() == 0


def test_last_address_wins_and_sums_by_stage(spark):
    animals = spark.createDataFrame([("r1", 1), ("r2", 2), ("r9", 3), (None, 4)], "rel string, n int")
    addresses = spark.createDataFrame([("r1", "old", 1), ("r1", "new", 2), ("r2", None, 3), ("", "x", 4)], "rel string, street string, line int")
    assert rows(records.combined(animals, addresses, "rel", "line")) == [("r1", 1, "new"), ("r2", 2, "")]
    assert rows(records.combined(animals, addresses, "rel", "line", missing=True)) == sorted([("r1", 1, "new"), ("r2", 2, ""), ("r9", 3, ""), (None, 4, "")], key=repr)
    df = spark.createDataFrame([("pigs", "draft", 2), ("pigs", "final", 3), ("pigs", "final", 4), ("hens", "other", 9), ("x", "final", 1)], "c string, s string, n long")
    assert rows(metrics.by_stage(df, "c", "s", "n", ["pigs", "hens", "goats"], ["final", "draft"])) == [("goats", 0, 0), ("hens", 0, 0), ("pigs", 7, 2)]


def test_inputs_are_found(spark, tmp_path):
    from noticeweave.sources import files

    for name in ("2024_01_02", "2025_01_01", "data"):
        (tmp_path / name).mkdir()
    assert files.first_existing(spark, [f"{tmp_path}/none", f"{tmp_path}/2*", f"{tmp_path}/data"]).endswith("2025_01_01")
    assert files.since_clause("a=b", "2024-01-01") == "(a=b) AND dt.available>=2024-01-01" and files.since_clause("a=b", None) == "a=b"
    try:
        files.first_existing(spark, [f"{tmp_path}/none"])
    except FileNotFoundError:
        return
    raise AssertionError("nothing was there")
