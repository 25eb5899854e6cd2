"""Text normalisers as column expressions; null is treated as the empty string and never returned."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin letters with marks and what they fold to.
_FOLD = {
    "a": "àáâãäåāăą", "c": "çćĉċč", "d": "ď", "e": "èéêëēĕėęě", "g": "ĝğġģ", "h": "ĥ", "i": "ìíîïĩīĭį", "j": "ĵ", "k": "ķ",
    "l": "ĺļľ", "n": "ñńņň", "o": "òóôõöōŏő", "r": "ŕŗř", "s": "śŝşš", "t": "ţť", "u": "ùúûüũūŭůűų", "w": "ŵ", "y": "ýÿŷ", "z": "źżž",
}
_FROM = FOLDED_LETTERS = "".join(_FOLD.values())
_TO = "".join(base * len(marked) for base, marked in _FOLD.items())
# Tokens that stand for a missing value.
MISSING = ["", "nan", "none", "null", "nat"]
# Words left out of names that are matched with registers, and out of names that are compared as they are written; the signs
# that part words in the latter.
MATCH_STOPWORDS = ["maatschap", "mts", "vof", "v.o.f", "vennootschap", "firma", "onder", "vennootschaponderfirma", "vof.", "bv", "b.v", "b.v.", "holding", "melkveebedrijf", "melkvee", "melkveehouderij", "bedrijf"]
NAME_STOPWORDS = ["bv", "b.v.", "vof", "v.o.f.", "stichting", "maatschap", "mts", "vennootschap", "onder", "firma"]
NAME_SIGNS = ",.;:-/\\|()[]{}'\""


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fold(c: Column | str) -> Column:
    """Trimmed, lower-cased, letters without their marks."""
    return F.regexp_replace(F.translate(F.lower(F.trim(text(c))), _FROM, _TO), r"\p{M}+", "")


def clean_text(c: Column | str) -> Column:
    """Folded words with single spaces; punctuation separates."""
    return F.trim(F.regexp_replace(F.regexp_replace(fold(c), r"(?U)[^\w\s]", " "), r"(?U)\s+", " "))


def clean_code(c: Column | str) -> Column:
    return F.regexp_replace(fold(c), r"(?U)[^\w-]", "")


def clean_postcode(c: Column | str) -> Column:
    return F.upper(F.regexp_replace(fold(c), r"(?U)[^\w]", ""))


def postcode(c: Column | str) -> Column:
    """'1234 AB', or empty unless it is four digits and two letters."""
    found = F.upper(F.regexp_extract(text(c), r"^\s*(\d{4})\s*([A-Za-z]{2})\s*$", 0))
    return F.when(found == "", "").otherwise(F.concat(F.regexp_extract(found, r"(\d{4})", 1), F.lit(" "), F.regexp_extract(found, r"([A-Z]{2})", 1)))


def register_number(c: Column | str) -> Column:
    """A register number without a decimal tail and leading zeros; other signs stay."""
    return F.ltrim(F.regexp_replace(F.trim(text(c)), r"\.0$", ""), F.lit("0"))


def clean_missing(c: Column | str) -> Column:
    """Trimmed text; tokens that stand for a missing value become empty."""
    trimmed = F.trim(text(c))
    return F.when(F.lower(trimmed).isin(MISSING), "").otherwise(trimmed)


def name_key(c: Column | str) -> Column:
    """A name's words without those that say what kind of firm it is, sorted; repeats stay."""
    words = F.filter(F.split(clean_text(c), " "), lambda w: (w != "") & ~w.isin(MATCH_STOPWORDS))
    return F.array_join(F.array_sort(words), " ")


def plain_name(c: Column | str) -> Column:
    """A name in lower case without signs and legal forms, its words in their order; letters keep their marks."""
    spaced = F.translate(F.lower(text(c)), NAME_SIGNS, " " * len(NAME_SIGNS))
    return F.array_join(F.filter(F.split(F.trim(spaced), r"(?U)\s+"), lambda w: (w != "") & ~w.isin(NAME_STOPWORDS)), " ")


def title_tokens(c: Column | str) -> Column:
    """The first letter of every word in upper case, the rest as it is."""
    return F.array_join(F.transform(F.split(F.trim(text(c)), r"\s+"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))), " ")


def slug(c: Column | str) -> Column:
    """A label for file names: as a province is written, with underscores for spaces and slashes."""
    return F.translate(province(c), " /", "__")


def house_number(c: Column | str) -> Column:
    """'9.0' becomes '9'."""
    return F.regexp_replace(F.trim(text(c)), r"^(\d+)\.0+$", "$1")


def absolute_url(link: Column | str, base: str) -> Column:
    given = F.trim(text(link))
    return F.when(given == "", "").when(given.rlike("^https?://"), given).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(given, F.lit("/"))))


def file_name(c: Column | str) -> Column:
    """The name of a linked file: the last part of the link's path, decoded (a malformed escape stays as it is), other signs than letters, digits,
    dot, dash and underscore replaced, without dots and underscores at its ends; 'download' if nothing is left; ending in .pdf."""
    path = F.regexp_replace(F.regexp_replace(text(c), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*", ""), r"(?s)[?#].*$", "")
    last = F.regexp_replace(F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1), r"(?s);.*$", "")
    whole = F.replace(F.regexp_replace(last, "%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    name = F.regexp_replace(F.regexp_replace(F.url_decode(whole), r"[^A-Za-z0-9._-]", "_"), r"^[._]+|[._]+$", "")
    name = F.when(name == "", "download").otherwise(name)
    return F.when(F.lower(name).endswith(".pdf"), name).otherwise(F.concat(name, F.lit(".pdf")))


# Elements whose content is not text of a page, and what follows a text that was cut.
HIDDEN_TAGS = ["script", "style", "nav", "header", "footer", "noscript", "iframe", "aside"]
CUT_MARK = " [truncated]"


def html_text(c: Column | str, most: int | None = None, marker: str = CUT_MARK) -> Column:
    """Text of a short piece of markup by patterns alone: hidden elements and tags dropped, eight references decoded, white space collapsed.
    sources.tags.page_text reads whole pages."""
    out = F.regexp_replace(text(c), rf"(?is)<({'|'.join(HIDDEN_TAGS)})\b.*?</\1\s*>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"(?s)<!--.*?-->", " "), r"(?s)<[^>]*>", " ")
    for reference, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")):
        out = F.replace(out, F.lit(reference), F.lit(sign))
    out = F.trim(F.regexp_replace(out, r"\s+", " "))
    return out if most is None else F.when(F.length(out) > most, F.concat(F.substring(out, 1, most), F.lit(marker))).otherwise(out)


def joined_texts(*columns: Column | str) -> Column:
    """Texts that are not empty, with a rule between them."""
    return F.concat_ws("\n\n---\n\n", *[F.nullif(F.trim(text(c)), F.lit("")) for c in columns])


def thousands(c: Column | str) -> Column:
    """A whole number with points between thousands."""
    return F.translate(F.format_number(c, 0), ",", ".")


def location_kind(visiting: Column | str, postal: Column | str, missing: str = "Ontbreekt") -> Column:
    known = lambda c: (text(c) != "") & (text(c) != missing)
    return F.when(known(visiting), "bezoeklocatie").when(known(postal), "postlocatie").otherwise("")


def _first_match(c: Column, pattern: str) -> tuple[Column, Column]:
    """Where the first match begins (from 1, 0 if there is none), and its text."""
    return F.regexp_instr(c, F.lit(f"(?iu)(?:{pattern})")), F.regexp_extract(c, f"(?iu)({pattern})", 1)


def evidence_sentence(c: Column | str, pattern: str) -> Column:
    """The stretch between . ; : around the first match, with the sign that ends it; empty without match. The match is found first and
    the text cut around it, so long texts without stops take no longer than others."""
    c = text(c)
    at, match = _first_match(c, pattern)
    before, after = F.substring(c, F.lit(1), at - 1), F.substring(c, at + F.length(match), F.length(c))
    left = F.element_at(F.split(before, "[.;:]", -1), -1)
    right = F.regexp_extract(after, r"(?s)^[^.;:]*+[.;:]?", 0)
    return F.when(at > 0, F.trim(F.concat(left, match, right))).otherwise("")


def keyword_in_context(c: Column | str, pattern: str, around: int = 5) -> Column:
    """The words of the first match with up to `around` words on either side, single spaces; empty without match."""
    c = text(c)
    at, match = _first_match(c, pattern)
    before = F.split(F.substring(c, F.lit(1), at - 1), r"\s+", -1)
    after = F.split(F.substring(c, at + F.length(match), F.length(c)), r"\s+", around + 2)
    # The last piece before and the first piece behind belong to the match's own words.
    near = F.slice(before, F.greatest(F.size(before) - around, F.lit(1)), around + 1)
    own = F.concat(F.array_join(near, " "), match, F.array_join(F.slice(after, 1, around + 1), " "))
    return F.when(at > 0, F.trim(F.regexp_replace(own, r"\s+", " "))).otherwise("")


def compared(c: Column | str) -> Column:
    """For comparisons only: lower case, single spaces, missing tokens empty."""
    return F.trim(F.regexp_replace(F.lower(clean_missing(c)), r"\s+", " "))


# The names of provinces that are written in several ways.
PROVINCE_NAMES = {
    "fryslan": "friesland", "fryslân": "friesland", "friesland": "friesland", "noord brabant": "noord-brabant", "noordbrabant": "noord-brabant", "brabant": "noord-brabant", "n brabant": "noord-brabant",
    "zuid holland": "zuid-holland", "zuidholland": "zuid-holland", "z holland": "zuid-holland", "noord holland": "noord-holland", "noordholland": "noord-holland", "n holland": "noord-holland",
}


def province(c: Column | str) -> Column:
    """A province's name in lower case without 'provincie', with spaces for hyphens, underscores and dots; those of PROVINCE_NAMES in one spelling."""
    bare = F.replace(F.lower(F.trim(text(c))), F.lit("provincie "), F.lit(""))
    bare = F.trim(F.regexp_replace(bare, r"(?U)[-_.\s]+", " "))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in PROVINCE_NAMES.items() for x in pair]), bare), bare)


def prefix(c: Column | str, sign: str = "-") -> Column:
    """What stands before the first sign."""
    return F.substring_index(text(c), sign, 1)


def listed(c: Column | str, sign: str = ",") -> Column:
    """The parts of a list in a text, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text(c), sign), lambda x: F.trim(x)), lambda x: x != "")


def joined_once(values: Column, separator: str = " | ") -> Column:
    """Texts in their order, each once whatever its case, joined; blank ones left out. The first spelling stays."""
    some = F.filter(F.transform(values, lambda v: F.trim(F.coalesce(v, F.lit("")))), lambda v: v != "")
    lower = F.transform(some, F.lower)
    first = F.filter(some, lambda v, i: F.array_position(lower, F.lower(v)) == i + 1)
    return F.array_join(first, separator)


# What stands before and behind a company's name in notices of one province.
COMPANY_BEFORE, COMPANY_BEHIND = r"(?iu)bedrijf\s*[:\-]", r"(?iu)locatie\s*[:\-]"


def company_name(c: Column | str) -> Column:
    """The name between 'bedrijf:' and 'locatie:' (or with dashes), of any length, empty if there is none."""
    c = text(c)
    begin = F.regexp_instr(c, F.lit(COMPANY_BEFORE))
    rest = F.substring(c, begin + F.length(F.regexp_extract(c, f"({COMPANY_BEFORE})", 1)), F.length(c))
    end = F.regexp_instr(rest, F.lit(COMPANY_BEHIND))
    name = F.regexp_replace(F.substring(rest, F.lit(1), end - 1), r"(?U)\s+", " ")
    return F.when((begin > 0) & (end > 0), F.regexp_replace(name, r"^[ :;\-.,]+|[ :;\-.,]+$", "")).otherwise("")


def kept_company(name: Column | str, c: Column | str, *places: Column | str) -> Column:
    """The company name, found in the text where blank, of notices of Noord-Brabant (told by any of places); blank for others."""
    own, inside = text(name), F.lit(False)
    for place in places:
        inside = inside | F.contains(F.lower(text(place)), F.lit("noord-brabant"))
    return F.when(inside, F.when(F.trim(own) != "", own).otherwise(company_name(c))).otherwise("")


def housing_text_category(code: Column | str, housing: Column | str) -> Column:
    """The older report's category: by code A4 or A, else the housing's own words in lower case without 'huisvesting', where 'kalkoe' is written
    'kalkoenen' and 'rundve' 'rundvee'."""
    c = F.trim(text(code))
    own = F.trim(F.replace(F.trim(F.lower(text(housing))), F.lit("huisvesting"), F.lit("")))
    own = F.replace(F.replace(own, F.lit("kalkoe"), F.lit("kalkoenen")), F.lit("rundve"), F.lit("rundvee"))
    return F.when(F.startswith(c, F.lit("A4")), "vleeskalveren").when(F.startswith(c, F.lit("A")), "rundvee (excl. kalveren)").otherwise(own)


def positive(c: Column | str) -> Column:
    """Whether a text is a number above zero; anything else is not."""
    return F.coalesce(text(c).try_cast("double") > 0, F.lit(False))
