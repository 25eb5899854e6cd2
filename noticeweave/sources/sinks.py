"""Sinks: ordered CSV, appends that skip what is there, run logs, metrics as JSON, and side outputs."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from noticeweave.operators.durable import drop_folder
from noticeweave.sources.files import string_csv


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _system(spark, path)
    return system.exists(place)


def arranged(df: DataFrame, first: list[str]) -> DataFrame:
    """The known columns in their order (null where df lacks them), then the others as they stand."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in first], *[c for c in df.columns if c not in first])


def write_csv(df: DataFrame, path: str, columns: list[str], *order: Column | str) -> DataFrame:
    """Overwrites a folder of CSV files with the given columns as texts, sorted over all files if an order is given; returns what is there."""
    chosen = (df.orderBy(*order) if order else df).select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])
    chosen.write.mode("overwrite").options(header=True, escape='"', emptyValue="").csv(path)
    return string_csv(df.sparkSession, path, columns)


def append_new(df: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Appends the rows whose key is not there yet, each key once; the table's rows afterwards. A run that broke off is simply run again."""
    spark = df.sparkSession
    fresh = df.dropDuplicates(keys)
    if exists(spark, path):
        fresh = fresh.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti")
    fresh.write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], **values: Column) -> dict:
    """Writes df and returns the given aggregates of what was written, taken in the same pass; for a frame without any partition, none."""
    seen = Observation()
    write(df.observe(seen, *[c.alias(n) for n, c in values.items()]))
    return seen.get


def write_side(df: DataFrame, path: str) -> int:
    """Writes a side output (failures, corrections, mismatches) and returns its rows; an empty one leaves no folder."""
    n = write_observed(df, lambda own: own.write.mode("overwrite").parquet(path), rows=F.count(F.lit(1))).get("rows", 0)
    if not n:
        drop_folder(df.sparkSession, path)
    return n


def write_metadata(spark: SparkSession, path: str, fetched: int, new: int, available: int, start: int = 1, limit: int | None = None, chunk: int = 0) -> DataFrame:
    """One row of JSON beside a table: what was fetched and is new, whether the cap was reached, and whether the source has more."""
    row = {"fetched_rows": fetched, "new_rows": new, "total_available": available, "start_record": start, "max_records": limit, "chunk_size": chunk}
    row |= {"reached_cap": limit is not None and fetched >= limit, "more_available": available > 0 and start - 1 + fetched < available}
    spark.createDataFrame([(json.dumps(row),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.schema("fetched_rows long, new_rows long, total_available long, start_record long, max_records long, chunk_size long, reached_cap boolean, more_available boolean").json(path)


def log_run(spark: SparkSession, path: str, run_id: str, rows: int) -> DataFrame:
    """Appends one row (run_id, rows) for a run; the log of all runs."""
    spark.createDataFrame([(run_id, rows)], "run_id string, rows long").coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def write_metrics(metrics: dict[str, DataFrame], path: str) -> DataFrame:
    """Metrics as (metric, row as JSON), written and read back: what draws them needs nothing else."""
    whole = None
    for name, df in metrics.items():
        rows = df.select(F.lit(name).alias("metric"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
        whole = rows if whole is None else whole.unionByName(rows)
    whole.write.mode("overwrite").json(path)
    return whole.sparkSession.read.schema("metric string, value string").json(path)


def free_path(spark: SparkSession, path: str) -> str:
    """path, or path_1, path_2 and so on: the first that does not exist."""
    i = 0
    while exists(spark, path if not i else f"{path}_{i}"):
        i += 1
    return path if not i else f"{path}_{i}"
