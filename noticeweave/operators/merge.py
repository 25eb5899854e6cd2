"""Upserts, unions with precedence, and flags by membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def upsert(fresh: DataFrame, existing: DataFrame, keys: list[str], derived: list[str], keep_deleted: bool = False) -> DataFrame:
    """Fresh rows, with the derived columns of the existing row of the same key; rows only in existing go unless kept."""
    known = existing.select(*keys, *[F.col(c).alias(f"__{c}") for c in derived])
    merged = fresh.join(known, keys, "left")
    out = merged.select(*[c for c in fresh.columns if c not in derived], *[F.coalesce(F.col(f"__{c}"), F.col(c) if c in fresh.columns else F.lit(None)).alias(c) for c in derived])
    return out.unionByName(existing.join(fresh, keys, "left_anti"), allowMissingColumns=True).select(*out.columns) if keep_deleted else out


def union_first(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of the parts, of each key the row of the earliest part (of equals the smallest), combined before the shuffle."""
    whole = parts[0].withColumn("__part", F.lit(0))
    for i, p in enumerate(parts[1:], 1):
        whole = whole.unionByName(p.withColumn("__part", F.lit(i)), allowMissingColumns=True)
    rest = [c for c in whole.columns if c not in (*keys, "__part")]
    row = F.struct(*rest) if rest else F.struct("__part")
    best = whole.groupBy(*keys).agg(F.min(F.struct("__part", row.alias("row"))).alias("__best"))
    return best.select(*keys, *[F.col("__best.row")[c].alias(c) for c in rest])


def with_flag(df: DataFrame, others: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """df with a boolean that says whether the key occurs in others."""
    marks = others.select(*keys).distinct().withColumn("__hit", F.lit(True))
    return df.join(marks, keys, "left").withColumn(flag, F.col("__hit").isNotNull()).drop("__hit")


def first_columns(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under standard names: of each list of candidates that df has the first that is filled, empty text if none is."""
    filled = lambda c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string"))
    return df.select(*[F.coalesce(*[filled(c) for c in found if c in df.columns], F.lit("")).alias(name) for name, found in aliases.items()])


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df
