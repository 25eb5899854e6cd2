"""One row of many: first, latest, by precedence, with ties settled by the order given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_fields(df: DataFrame, keys: list[str], order: Column, fields: list[str]) -> DataFrame:
    """The fields of the row with the smallest order value of each key, combined before the shuffle (no sort, no window)."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*fields), order).alias("__row")).select(*keys, *[F.col(f"__row.{f}").alias(f) for f in fields])


def latest_status(df: DataFrame, key: str, date: str, status: str, ranks: dict[str, int], tie: str) -> DataFrame:
    """The latest row of each key: by date (undated rows last), then the rank of the status, then the largest tie value."""
    rank = F.lit(-1)
    for name, value in ranks.items():
        rank = F.when(F.col(status) == name, value).otherwise(rank)
    best = F.max_by(F.struct(date, status, tie), F.struct(F.coalesce(F.col(date).cast("timestamp"), F.lit("0001-01-01").cast("timestamp")), rank, F.col(tie)))
    return df.groupBy(key).agg(best.alias("__row")).select(key, *[F.col(f"__row.{f}").alias(f) for f in (date, status, tie)])


def by_precedence(df: DataFrame, keys: list[str], label: str, order: list[str]) -> DataFrame:
    """The label of each key that stands first in order; labels not listed come last."""
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col(label)), F.lit(0))
    return df.groupBy(*keys).agg(F.min_by(label, F.when(rank == 0, len(order) + 1).otherwise(rank)).alias(label))


def most_frequent(column: str) -> Column:
    """The most frequent value that is not blank; the smallest of equally frequent ones."""
    return F.mode(F.nullif(F.col(column), F.lit("")), deterministic=True)


def joined_set(column: str, separator: str = ",") -> Column:
    """Distinct values that are not blank, sorted and joined."""
    return F.array_join(F.array_sort(F.collect_set(F.nullif(F.col(column).cast("string"), F.lit("")))), separator)
