"""Streams that stop and go on, with repeats and late rows."""

from pyspark.sql import functions as F

from noticeweave.streaming import ingest

SCHEMA = "id long, kind string, ts timestamp"


def put(spark, folder, name, rows):
    spark.createDataFrame([(i, k, t) for i, k, t in rows], "id long, kind string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{folder}/in/{name}")


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{folder}/in")


def test_repeats_in_later_files_and_after_a_restart_are_left_out(spark, tmp_path):
    folder = str(tmp_path)
    run = lambda: ingest.run_available(ingest.deduplicated(stream(spark, folder), ["id"], "ts", "10 days"), f"{folder}/out")
    put(spark, folder, "a", [(1, "x", "2024-01-01"), (2, "y", "2024-01-02"), (1, "x", "2024-01-01")])
    assert sorted(r["id"] for r in run().collect()) == [1, 2]
    put(spark, folder, "b", [(2, "y", "2024-01-02"), (3, None, "2024-01-03")])
    assert sorted(r["id"] for r in run().collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in run().collect()) == [1, 2, 3]


def test_counts_go_on_after_a_restart_and_late_windows_are_closed(spark, tmp_path):
    folder = str(tmp_path)

    def run():
        found = ingest.run_updates(ingest.binned(stream(spark, folder), "ts", "1 day", "2 days", "kind"), ["start", "kind"], f"{folder}/out")
        return {(str(r["start"])[:10], r["kind"]): r["n"] for r in found.collect()}

    put(spark, folder, "a", [(1, "x", "2024-01-01 10:00:00"), (2, "x", "2024-01-01 11:00:00"), (3, None, "2024-01-02 00:00:00")])
    assert run() == {("2024-01-01", "x"): 2, ("2024-01-02", None): 1}
    put(spark, folder, "b", [(4, "x", "2024-01-01 12:00:00"), (5, "x", "2024-01-20 12:00:00")])
    assert run() == {("2024-01-01", "x"): 3, ("2024-01-02", None): 1, ("2024-01-20", "x"): 1}
    put(spark, folder, "c", [(6, "x", "2024-01-01 12:00:00"), (7, "x", "2024-01-19 12:00:00")])
    assert run() == {("2024-01-01", "x"): 3, ("2024-01-02", None): 1, ("2024-01-20", "x"): 1, ("2024-01-19", "x"): 1}


def test_lookups_ask_for_each_missing_key_once(spark, tmp_path):
    folder, asked = str(tmp_path), []
    spark.createDataFrame([(1, "old")], "id long, answer string").write.parquet(f"{folder}/answers")

    def look_up(keys):
        asked.extend(r["id"] for r in keys.collect())
        return keys.withColumn("answer", F.concat(F.lit("new "), F.col("id").cast("string")))

    run = lambda: {r["id"]: r["answer"] for r in ingest.run_lookups(stream(spark, folder), ["id"], look_up, f"{folder}/answers", f"{folder}/out").collect()}
    put(spark, folder, "a", [(1, "x", "2024-01-01"), (2, "x", "2024-01-01"), (2, "y", "2024-01-02"), (None, "z", "2024-01-02")])
    assert run() == {1: "old", 2: "new 2"}
    put(spark, folder, "b", [(2, "x", "2024-01-03"), (3, "x", "2024-01-03")])
    assert run() == {1: "old", 2: "new 2", 3: "new 3"}
    assert sorted(asked) == [2, 3]
