"""Addresses of notices held against those in their titles: what differs, and the rows to mend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.functions.address import chosen_address, materially_differ, title_address
from noticeweave.functions.text import clean_missing, text

#: The parts of an address, as title_address() names them.
PARTS = ["street", "house_number", "house_number_suffix", "postcode", "place"]


def once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """rows with a column that is computed once a row, however often it is used behind: an optimiser that writes large expressions into
    each place of their use stops at generated rows."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _told(rows: DataFrame, title: str, body: str, given: dict[str, str]) -> DataFrame:
    """rows with the structs __given, __own (the title's, null without one) and __chosen; given names the columns of the parts."""
    parts = F.struct(*[clean_missing(given[p]).alias(p) for p in PARTS], F.lit(None).cast("double").alias("confidence"))
    own = once(once(rows, "__given", parts), "__own", title_address(title))
    return once(own, "__chosen", chosen_address(title, F.col("__given"), body, F.col("__own")))


def address_mismatches(rows: DataFrame, title: str, body: str, given: dict[str, str], keep: list[str]) -> DataFrame:
    """The audit of rows whose two addresses are complete and differ: the columns of keep, and the parts of each address with given_, title_
    and chosen_ before their names."""
    told = _told(rows, title, body, given).where(materially_differ(F.col("__given"), F.col("__own")))
    sides = (("given", "__given"), ("title", "__own"), ("chosen", "__chosen"))
    return told.select(*[text(F.col(c).cast("string")).alias(c) for c in keep], *[text(F.col(s)[p]).alias(f"{name}_{p}") for name, s in sides for p in PARTS])


def address_repairs(rows: DataFrame, key: str, title: str, body: str, given: dict[str, str]) -> DataFrame:
    """(key, the columns of given, confidence) of the rows alone that get another address: that of their title."""
    told = _told(rows, title, body, given).where("__own IS NOT NULL")
    same: Column = F.lit(True)
    for p in PARTS:
        same = same & (text(F.col("__chosen")[p]) == F.col("__given")[p])
    return told.where(~same).select(key, *[text(F.col("__chosen")[p]).alias(given[p]) for p in PARTS], F.col("__chosen")["confidence"].alias("confidence"))


def repaired(rows: DataFrame, repairs: DataFrame, key: str) -> DataFrame:
    """rows with the repairs' values where there are any; a key has one repair at most. Further columns of repairs are not taken."""
    changed = [c for c in repairs.columns if c != key and c in rows.columns]
    side = repairs.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in changed])
    joined = rows.join(side, F.col(key) == F.col("__key"), "left")
    return joined.select(*[F.when(F.col("__key").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in changed else c for c in rows.columns])
