"""Incremental ingest with Structured Streaming; the result equals the batch query's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StructField, StructType

from noticeweave.operators.durable import new_folder
from noticeweave.sources.sinks import append_new


def stream_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stream of a table's parquet files as they appear."""
    schema: StructType = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _run(writer: DataStreamWriter, state: str) -> None:
    writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def run_available(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Takes in what is there now and returns all rows written. Rows and state are kept in folder: run again with the same one, it goes on
    where it stopped; without one it begins anew."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")
    _run(stream.writeStream.format("parquet").option("path", f"{folder}/rows"), f"{folder}/state")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_updates(stream: DataFrame, keys: list[str], folder: str | None = None) -> DataFrame:
    """Like run_available for aggregates: each batch writes the rows that it changed into a folder of its own (a batch that is repeated
    overwrites it), and of each key the latest row counts. The state ends with the watermark; no batch rewrites older rows."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")
    write = lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/rows/__batch={number}")
    _run(stream.writeStream.outputMode("update").foreachBatch(write), f"{folder}/state")
    changes = spark.read.schema(StructType([*stream.schema.fields, StructField("__batch", LongType())])).parquet(f"{folder}/rows")
    rest = [c for c in stream.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "__batch").alias("__row")).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def run_lookups(stream: DataFrame, keys: list[str], look_up: Callable[[DataFrame], DataFrame], answers: str, folder: str | None = None) -> DataFrame:
    """Looks up the keys that the table of answers lacks, batch by batch, and appends what look_up returns for them (keys and more columns,
    the same as in answers). A run that broke off asks only for what is still missing. Returns the table."""
    spark = stream.sparkSession
    folder = folder or new_folder(spark, "stream")

    def take(batch: DataFrame, _: int) -> None:
        asked = batch.select(*keys).na.drop(subset=keys).distinct()
        known = batch.sparkSession.read.parquet(answers).select(*keys)
        append_new(look_up(asked.join(known, keys, "left_anti")), answers, keys)

    _run(stream.writeStream.foreachBatch(take), f"{folder}/state")
    return spark.read.parquet(answers)


def deduplicated(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The first row of each key that arrives, remembered for as long as late rows are waited for."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def binned(stream: DataFrame, ts: str, width: str, late: str, *by: str) -> DataFrame:
    """Counts by time window; a window's count is kept for as long as late rows are waited for."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return timed.groupBy(F.window(ts, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")
