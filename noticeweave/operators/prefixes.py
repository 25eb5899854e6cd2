"""Joins where one text begins the other, for names that one of the sides has cut off."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.functions.text import text
from noticeweave.operators.durable import drop_durable, durable

LEFT, RIGHT = 1, 2


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (key, left, right) of texts in their order in a range; those told of before the range only open intervals.

    All texts that a text begins stand right behind it, so its interval is open for as long as the texts begin with it, and what is open at a
    text is the chain of its own beginnings.
    """
    here, open_ = None, []
    for batch in batches:
        found: list[tuple[str, str, str]] = []
        for part, key, value, sides, carried in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "value", "sides", "carried"))):
            if (part, key) != here:
                here, open_ = (part, key), []
            while open_ and not value.startswith(open_[-1][0]):
                open_.pop()
            if not carried:
                for shorter, own in open_:
                    if own & LEFT and sides & RIGHT:
                        found.append((key, shorter, value))
                    if own & RIGHT and sides & LEFT:
                        found.append((key, value, shorter))
                if sides == LEFT | RIGHT:
                    found.append((key, value, value))
            if value:  # nothing begins with what is empty
                open_.append((value, sides))
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["key", "left", "right"])


def _side(df: DataFrame, id: str, key: list[str], value: str) -> DataFrame:
    return df.select(F.col(id).alias("id"), F.to_json(F.array(*[text(F.col(c).cast("string")) for c in key])).alias("key"), text(value).alias("value"))


def prefix_values(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct (key, left, right) of two tables (key, value) with the same key and a left value that begins the right one, or the other way
    round; an empty value only equals an empty one.

    The distinct values are laid out in ranges by key and value, so that a key with very many values lies in several. A range needs the
    beginnings of its first value that lie in ranges before it: these are looked up for the first values alone, one a range.
    """
    forms = left.select("key", "value", F.lit(LEFT).alias("side")).unionByName(right.select("key", "value", F.lit(RIGHT).alias("side")))
    forms = forms.groupBy("key", "value").agg(F.bit_or("side").alias("sides"))
    ranged = durable(forms.repartitionByRange("key", "value").withColumn("part", F.spark_partition_id()), "prefix-ranges")
    heads = ranged.groupBy("part").agg(F.min(F.struct("key", "value")).alias("head")).select("part", "head.*").where("length(value) > 1")
    cut = heads.select("part", "key", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda n: F.substring("value", F.lit(1), n))).alias("value"))
    before = cut.join(ranged.select("key", "value", "sides", F.col("part").alias("own")), ["key", "value"]).where("own < part")
    rows = ranged.withColumn("carried", F.lit(False)).unionByName(before.drop("own").withColumn("carried", F.lit(True)))
    swept = rows.repartition("part").sortWithinPartitions("part", "key", "value").select("part", "key", "value", "sides", "carried")
    pairs = durable(swept.mapInArrow(_sweep, "key string, left string, right string"), "prefix-pairs")
    drop_durable(ranged)
    return pairs


def prefix_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: list[str], value: str) -> DataFrame:
    """(left_id, right_id, left_value, right_value) of all rows with the same key columns whose values are equal or of which one begins
    the other. Nulls count as empty; empty values match empty ones only. Rows that repeat match each for themselves. Work goes with
    the rows and the pairs found: no two values are compared but those of which one begins the other."""
    a, b = _side(left, left_id, key, value), _side(right, right_id, key, value)
    pairs = prefix_values(a, b).withColumnsRenamed({"left": "left_value", "right": "right_value"})
    one = a.select(F.col("id").alias("__left"), "key", F.col("value").alias("left_value")).join(pairs, ["key", "left_value"])
    both = one.join(b.select(F.col("id").alias("__right"), "key", F.col("value").alias("right_value")), ["key", "right_value"])
    return both.select(F.col("__left").alias(left_id), F.col("__right").alias(right_id), "left_value", "right_value")
