"""Streaming forms of the incremental steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeweave.operators.durable import new_folder
from noticeweave.plans.registry import Tables, query
from noticeweave.sources import paged
from noticeweave.streaming import ingest


@query("SELECT event_id, user_id, event_type FROM events")
def stream_ingest_dedupe(t: Tables) -> DataFrame:
    stream = ingest.stream_of(t._spark, t._folder, "events")
    twice = stream.select(F.inline(F.array(F.struct("event_id", "user_id", "event_type", "ts"), F.struct("event_id", "user_id", "event_type", "ts"))))
    return ingest.run_available(ingest.deduplicated(twice, ["event_id"], "ts", "60 days")).select("event_id", "user_id", "event_type")


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_histogram(t: Tables) -> DataFrame:
    """State is dropped 60 days behind the latest event."""
    return ingest.run_updates(ingest.binned(ingest.stream_of(t._spark, t._folder, "events"), "ts", "1 day", "60 days", "event_type"), ["start", "event_type"])


@query("""WITH u AS (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL) SELECT user_id, CASE WHEN user_id % 3 = 0 THEN 'answered before' ELSE coalesce(c_name, '') END AS answer
  FROM u LEFT JOIN customer ON c_custkey = user_id""")
def stream_lookups(t: Tables) -> DataFrame:
    """An earlier run has answered a part of the users."""
    answers = new_folder(t._spark, "answers")
    known = t.events.where("user_id % 3 = 0").select("user_id").distinct()
    known.withColumn("answer", F.lit("answered before")).write.parquet(answers)
    names = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("answer"))
    ask = lambda keys: keys.join(names, "user_id", "left").na.fill("", ["answer"])
    return ingest.run_lookups(ingest.stream_of(t._spark, t._folder, "events"), ["user_id"], ask, answers)


@query("SELECT o_orderkey AS id, o_orderstatus AS kind FROM orders")
def paged_stream(t: Tables) -> DataFrame:
    """A paged source as a stream; a second run goes on at the position where the first, which saw half of the responses, stopped."""
    folder, half = new_folder(t._spark, "responses"), new_folder(t._spark, "stream")
    rows = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("kind"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("available"))
    middle = rows.agg(F.percentile_approx("id", 0.5)).first()[0]
    first = paged.record_responses(rows.where(F.col("id") <= middle), folder, 1_000, "id")
    ingest.run_available(paged.paged_stream(t._spark, folder), half)
    paged.record_responses(rows.where(F.col("id") > middle), folder, 1_000, "id", first + 1)
    return ingest.run_available(paged.paged_stream(t._spark, folder), half).select(F.col("id").cast("bigint").alias("id"), "kind")
