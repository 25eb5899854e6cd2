"""Addresses: keys, spelling variants as blocking keys, and house numbers that stand for several."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeweave.functions.text import clean_code, clean_missing, clean_postcode, clean_text, compared, postcode, text, title_tokens

# Province codes after place names, words left out of them, tails of place names, and shortened street words.
PROVINCES = ["gld", "ov", "lb", "nb", "ut", "dr", "fr", "zh", "nh", "fl", "ze", "gr"]
PLACE_STOPS = ["aan", "de", "den", "der", "het", "in", "op", "te", "ten", "ter", "van"]
PLACE_TAILS = ["broek", "veen", "veld", "waard", "wijk", "dam", "berg", "bosch", "bos", "hout", "kamp", "land", "meer", "horst", "ratum"]
STREET_WORDS = [("straat", "str"), ("weg", "wg"), ("dijk", "dk"), ("laan", "ln"), ("steeg", "stg")]
STREET_PREFIXES, PLACE_PREFIX = (20, 18), 12


def address_key(street, number, suffix, code, place) -> Column:
    """street|number|suffix|postcode|place, each cleaned; empty unless street, number and place are there."""
    parts = [clean_text(c) for c in (street, number, suffix, code, place)]
    return F.when((parts[0] != "") & (parts[1] != "") & (parts[4] != ""), F.concat_ws("|", *parts)).otherwise("")


def number_and_suffix(number, suffix) -> tuple[Column, Column]:
    """The digits of a house number, and its addition: the one given, else the letters behind the digits."""
    raw, given = clean_code(number), clean_code(suffix)
    digits = F.regexp_extract(raw, r"^(\d+)", 1)
    pair = raw.rlike(r"^\d+[a-z]+$")
    return F.when((given != "") & (digits != ""), digits).when(pair, digits).otherwise(raw), F.when(given != "", given).when(pair, F.regexp_extract(raw, r"^\d+([a-z]+)$", 1)).otherwise("")


def match_key(street, number, suffix, code, place) -> Column:
    nr, addition = number_and_suffix(number, suffix)
    return F.concat_ws("|", clean_text(street), nr, addition, clean_postcode(code), clean_text(place))


def street_variants(street) -> Column:
    """Distinct spellings: as it is, its last word shortened or spelled out, without ir or dr in front, and two prefixes; an empty street has
    the empty one."""
    base = F.regexp_replace(clean_text(street), r"\byssel", "ijssel")
    words = F.split(base, " ")
    last, swapped = F.element_at(words, -1), F.lit(None).cast("string")
    for a, b in STREET_WORDS:
        swapped = F.when(last == a, b).when(last == b, a).otherwise(swapped)
    head = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
    ending = F.when(swapped.isNotNull(), F.array_join(F.concat(head, F.array(swapped)), " "))
    cut = [F.when(F.length(base) > n, F.substring(base, 1, n)) for n in STREET_PREFIXES]
    some = F.filter(F.array(base, ending, F.regexp_replace(base, r"^(ir|dr) ", ""), *cut), lambda v: v.isNotNull() & (v != ""))
    return F.when(base == "", F.array(F.lit(""))).otherwise(F.array_distinct(some))


def place_variants(place) -> Column:
    """Distinct spellings of a place; an empty place has the empty one, a mere province code none."""
    base = F.regexp_replace(clean_text(place), r"\byssel", "ijssel")
    bare = F.trim(F.regexp_replace(base, rf"(^| )({'|'.join(PROVINCES)})$", ""))
    words = F.split(bare, " ")
    kept = F.array_join(F.filter(words, lambda w: ~w.isin(PLACE_STOPS)), " ")
    headed = F.when(F.size(words) > 1, F.when(F.element_at(words, -1).isin(PLACE_TAILS), F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(1))), " ")))
    saint = F.when(bare.rlike("^st "), F.regexp_replace(bare, "^st ", "sint ")).when(bare.rlike("^sint "), F.regexp_replace(bare, "^sint ", "st "))
    some = F.filter(F.array(bare, saint, F.element_at(words, 1), kept, headed), lambda v: v.isNotNull() & (v != ""))
    cut = F.transform(F.filter(some, lambda v: F.length(v) > PLACE_PREFIX), lambda v: F.substring(v, 1, PLACE_PREFIX))
    return F.when(base == "", F.array(F.lit(""))).otherwise(F.array_distinct(F.concat(some, cut)))


def variant_keys(street, number, suffix, code, place) -> Column:
    """The match keys of all street and place spellings; none for an address without any part."""
    nr, addition = number_and_suffix(number, suffix)
    places = place_variants(place)
    zipcode = clean_postcode(code)
    keys = F.flatten(F.transform(street_variants(street), lambda s: F.transform(places, lambda p: F.concat_ws("|", s, nr, addition, zipcode, p))))
    return F.array_distinct(F.filter(keys, lambda k: F.replace(k, F.lit("|"), F.lit("")) != ""))


def all_variant_keys(keys) -> Column:
    """The variant keys of a comma-separated list of address keys (F13); short keys are padded, blank ones skipped."""
    each = F.filter(F.transform(F.split(text(keys), ","), lambda k: F.trim(k)), lambda k: k != "")

    def of(key: Column) -> Column:
        part = key_parts(key)
        return variant_keys(*[part[n] for n in ("street", "number", "suffix", "postcode", "place")])

    return F.array_distinct(F.flatten(F.transform(each, of)))


def key_parts(key) -> Column:
    """A struct of the five parts of an address key; missing ones are empty."""
    parts = F.split(text(key), r"\|")
    names = ("street", "number", "suffix", "postcode", "place")
    return F.struct(*[F.coalesce(F.try_element_at(parts, F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)])


# --- addresses in titles ---

_LETTERS = "A-Za-z\u00c0-\u00ff"
_STREET = rf"(?:^|,\s*|[-\u2013]\s*)([{_LETTERS}0-9'\u2019.\-/ ]+?)\s+"
_NUMBER = r"(\d+[A-Za-z]?(?:\s*(?:[-/]|en)\s*\d+[A-Za-z]?)*)"
_PLACE = rf"([{_LETTERS}'\u2019.\- ]+"
_CODE = r"(\d{4}\s*[A-Za-z]{2})"
#: The notations of an address in a title, in the order they are tried, with the groups of street, number, postcode and place.
TITLE_FORMS = [
    (rf"{_STREET}{_NUMBER}\s*,\s*{_PLACE})$", (1, 2, None, 3)),
    (rf"{_STREET}{_NUMBER}\s*,\s*{_CODE}\s+(?:(?:te|in)\s+)?{_PLACE}?)(?:$|,\s*Z|\(|,)", (1, 2, 3, 4)),
    (rf"{_STREET}{_NUMBER}(?:\s*,\s*{_CODE})?\s+(?:te|in)\s+{_PLACE}?)(?:$|[,(])", (1, 2, 3, 4)),
    (rf"\blocatie\s+([{_LETTERS}0-9'\u2019.\-/ ]+?)\s+{_NUMBER}(?:\s*,\s*{_CODE})?(?:\s+(?:te|in)\s+{_PLACE})|\s+{_PLACE}))?", (1, 2, 3, 4, 5)),
    (rf"{_STREET}(\d+[A-Za-z]?(?:\s*,\s*\d+[A-Za-z]?)*(?:\s+en\s+\d+[A-Za-z]?)?)(?:\s*,\s*{_CODE})?\s+{_PLACE})$", (1, 2, 3, 4)),
]
#: Streets whose titles leave out place or postcode.
TITLE_HINTS = {"knoevenoordstraat": ("Brummen", ""), "wapenvelder kerkweg": ("Wapenveld", "8191 KL")}
_PARTS = ("street", "house_number", "house_number_suffix", "postcode", "place")


def street_candidate(c) -> Column:
    """What stands behind the last dash and comma of a street's text, its words with a capital."""
    bare = F.regexp_replace(clean_missing(c), r"(?i)^locatie\s+", "")
    last = F.element_at(F.split(F.element_at(F.split(bare, r"\s+[\u2013-]\s+"), -1), ","), -1)
    return title_tokens(F.regexp_replace(F.regexp_replace(last, r"\s+", " "), r"^[ ,.-]+|[ ,.-]+$", ""))


def split_house_number(c) -> tuple[Column, Column]:
    """Digits and one to four letters apart; anything else is a number without addition."""
    bare = F.regexp_replace(F.regexp_replace(clean_missing(c), r"(?i)\s+en\s+ongenummerd\b", ""), r"^[ ,]+|[ ,]+$", "")
    pair = bare.rlike(r"^\d+[A-Za-z]{1,4}$")
    return F.when(pair, F.regexp_extract(bare, r"^(\d+)", 1)).otherwise(bare), F.when(pair, F.regexp_extract(bare, r"([A-Za-z]+)$", 1)).otherwise("")


def _address(street, number, suffix, code, place, sure) -> Column:
    columns = zip((*_PARTS, "confidence"), (street, number, suffix, code, place, sure))
    return F.struct(*[c.alias(n) for n, c in columns])


def title_address(title) -> Column:
    """A struct of street, house_number, house_number_suffix, postcode, place and confidence (0.95) from the first form of TITLE_FORMS that
    gives street, number and place; null if none does."""
    flat = lambda c: F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^[ ,]+|[ ,]+$", "")
    compact = flat(F.regexp_replace(flat(clean_missing(title)), r"(?i)\s+en\s+ongenummerd\b", ""))
    found = []
    for pattern, groups in TITLE_FORMS:
        part = [F.lit("") if g is None else F.regexp_extract(compact, "(?i)" + pattern, g) for g in groups]
        street, (number, suffix) = street_candidate(part[0]), split_house_number(part[1])
        place = title_tokens(clean_missing(F.when(part[3] != "", part[3]).otherwise(part[4] if len(part) > 4 else F.lit(""))))
        code = postcode(part[2])
        key = compared(street)
        for name, (hint, hint_code) in TITLE_HINTS.items():
            place = F.when((place == "") & (key == name), hint).otherwise(place)
            code = F.when((code == "") & (key == name), hint_code).otherwise(code)
        whole = (street != "") & (number != "") & (place != "")
        found.append(F.when(whole, _address(street, number, suffix, code, place, F.lit(0.95))))
    return F.coalesce(*found)


def _core(a: Column) -> list[Column]:
    return [compared(a[n]) for n in ("street", "house_number", "place")]


def looks_present(a: Column, c) -> Column:
    """Whether street, number and place of an address all stand in a text; false if one is blank."""
    hay = compared(c)
    out = hay != ""
    for part in _core(a):
        out = out & (part != "") & F.contains(hay, part)
    return out


def materially_differ(a: Column, b: Column) -> Column:
    """Whether two addresses, both with street, number and place, differ in these."""
    whole, same = F.lit(True), F.lit(True)
    for x, y in zip(_core(a), _core(b)):
        whole, same = whole & (x != "") & (y != ""), same & (x == y)
    return F.coalesce(a.isNotNull() & b.isNotNull() & whole & ~same, F.lit(False))


def chosen_address(title, given: Column, body, own: Column | None = None) -> Column:
    """The title's address if it stands in the title and the one given is incomplete or stands in neither title nor body; else the one given;
    whichever is there if only one is. `own` is the title's address if it is at hand."""
    own = title_address(title) if own is None else own
    complete = F.lit(True)
    for part in _core(given):
        complete = complete & (part != "")
    doubtful = ~complete | ~(looks_present(given, title) | looks_present(given, body))
    return F.when(own.isNull(), given).when(given.isNull(), own).when(looks_present(own, title) & doubtful, own).otherwise(given)


def key_address(key) -> Column:
    """The address of an address key, with confidence 0.8 (0 if street, number or place is missing)."""
    part = key_parts(key)
    whole = (part["street"] != "") & (part["number"] != "") & (part["place"] != "")
    return _address(part["street"], part["number"], part["suffix"], part["postcode"], part["place"], F.when(whole, 0.8).otherwise(0.0))


def split_suffix(number, suffix) -> tuple[Column, Column]:
    """'7a' without addition becomes '7' and 'a'; texts of several numbers stay."""
    nr, extra = split_house_number(number)
    fill = (F.trim(text(suffix)) == "") & (extra != "")
    return F.when(fill, nr).otherwise(F.trim(text(number))), F.when(fill, extra).otherwise(F.trim(text(suffix)))


def register_key(street, number, code, place) -> Column:
    """The match key of a register's address: no addition, no province code behind the place."""
    bare = F.regexp_replace(clean_text(place), rf" ({'|'.join(PROVINCES)})$", "")
    return F.concat_ws("|", clean_text(street), clean_code(number), F.lit(""), clean_postcode(code), bare)


def shown_address(street, number, suffix, code, place) -> Column:
    """'street number suffix, postcode place' without what is blank."""
    join = lambda *c: F.concat_ws(" ", *[F.nullif(clean_missing(x), F.lit("")) for x in c])
    return F.concat_ws(", ", *[F.nullif(x, F.lit("")) for x in (join(street, number, suffix), join(code, place))])


def lookup_query(number, suffix, code, name=None, register=None) -> Column:
    """What a register is asked for: its number, else the name; for places the postcode with the house number."""
    if register is not None:
        return F.coalesce(F.nullif(clean_missing(register), F.lit("")), F.nullif(clean_missing(name), F.lit("")), F.lit(""))
    return F.concat_ws(" ", F.nullif(clean_postcode(code), F.lit("")), F.nullif(F.concat(clean_code(number), clean_code(suffix)), F.lit("")))
