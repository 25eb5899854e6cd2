"""House numbers that stand for several, as a table function."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How several house numbers are written, and one number of a list and of a chain.
LIST_ITEM = re.compile(r"(\d+)([A-Za-z]{0,4})")
CHAIN_ITEM = re.compile(r"(\d+)([A-Za-z]*)")
PAIR = re.compile(r"(\d+)\s*(?:en|&)\s*(\d+)", re.IGNORECASE)
DASH = re.compile(r"\s*[-–]\s*")
END = re.compile(r"(\d+)([A-Za-z]?)")
THROUGH = re.compile(r"(\d+)\s*t/m\s*(\d+)", re.IGNORECASE)

Numbers = Iterator[tuple[str, str]]


def _items(parts: list[str], form: re.Pattern) -> Numbers:
    """The numbers and additions of all parts; none if any part has another form."""
    found = [form.fullmatch(p) for p in parts]
    return iter([(m[1], m[2].upper()) for m in found] if all(found) else [])


def several_numbers(raw: str | None) -> Numbers:
    """The single numbers, as (number, addition), that a text stands for; none if it is to be kept as it is.

    The first notation that fits decides: a list with commas and 'en'; two numbers with 'en' or '&'; a chain of three or more with dashes;
    two with a dash, each an end and not a range; 'a t/m b' for every number from the smaller to the larger. Repeats stay.
    """
    told = (raw or "").strip()
    if "," in told and " en " in told.lower():
        parts = [p.strip() for p in re.split(r",|\ben\b", told, flags=re.IGNORECASE)]
        if any(parts):
            return _items([p for p in parts if p], LIST_ITEM)
    if pair := PAIR.fullmatch(told):
        return iter([(pair[1], ""), (pair[2], "")])
    ends = DASH.split(told)
    if len(ends) > 1:
        return _items(ends, CHAIN_ITEM if len(ends) > 2 else END)
    if through := THROUGH.fullmatch(told):
        low, high = sorted((int(through[1]), int(through[2])))
        return ((str(n), "") for n in range(low, high + 1))
    return iter(())


class HouseNumbers:
    """Table function: rows (number, suffix) for what several_numbers() finds in a text, given one by one, so that a range of any length needs
    no more memory; for a text that is kept as it is, the text and the addition given with it."""

    def eval(self, raw: str, own: str) -> Numbers:
        found = several_numbers(raw)
        first = next(found, None)
        yield (raw, own) if first is None else first
        yield from found


house_numbers = F.udtf(HouseNumbers, returnType="number string, suffix string", useArrow=False)


def expanded(df: DataFrame, raw: Column | str, number: str, suffix: str) -> DataFrame:
    """df with a row for each house number that `raw` stands for, in columns of these names; where it is one number, or anything else, the
    row stays with the text and the addition that it has."""
    given = (F.col(raw) if isinstance(raw, str) else raw).cast("string")
    own = F.col(suffix).cast("string") if suffix in df.columns else F.lit("")
    rows = df.select(*[c for c in df.columns if c not in (number, suffix)], given.alias("__raw"), own.alias("__own"))
    single = house_numbers(F.col("__raw").outer(), F.col("__own").outer())
    return rows.lateralJoin(single).drop("__raw", "__own").withColumnsRenamed({"number": number, "suffix": suffix})
