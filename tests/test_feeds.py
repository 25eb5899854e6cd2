"""Paged sources, versioned tables, observed writes, identifiers as state, joins by prefix and sums over shared relations."""

import collections
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from noticeweave.operators import closure, identity, prefixes
from noticeweave.sources import files, paged, sinks, versions
from noticeweave.streaming import identifiers, ingest


@pytest.fixture
def recorded(spark, tmp_path):
    rows = spark.range(95).select((F.col("id") * 3).cast("string").alias("id"), F.lit("a<b&c").alias("kind"), F.date_format(F.date_add(F.lit("2020-01-01"), F.col("id").cast("int")), "yyyy-MM-dd").alias("available"))
    folder = f"file://{tmp_path}/pages"
    assert paged.record_responses(rows, folder, 20, "available") == 95
    return folder


def names(folder):
    return sorted(n for n in os.listdir(folder.removeprefix("file://")) if n.endswith(".xml"))


def test_paged_batch(spark, recorded, tmp_path):
    rows = paged.paged(spark, recorded).orderBy("position").collect()
    assert [(r.position, r.id, r.kind, r.subject) for r in rows] == [(i + 1, str(3 * i), "a<b&c", "") for i in range(95)]
    assert paged.paged(spark, recorded, limit=45).agg(F.count("*"), F.max("position")).first()[:] == (45, 45)
    log = f"file://{tmp_path}/log"
    late = paged.paged(spark, recorded, since="2020-03-25", log=log)
    assert "available" not in late._jdf.queryExecution().optimizedPlan().toString().split("Filter")[-1].split("\n")[0].replace("isnotnull(available", "")
    assert late.count() == 11 and len(os.listdir(log.removeprefix("file://"))) == 1  # one response has dates that late
    os.remove(f"{tmp_path}/pages/{names(recorded)[2]}")
    assert paged.paged(spark, recorded).count() == 40  # the chain ends where a response is missing
    assert paged.paged(spark, f"file://{tmp_path}/none").count() == 0


def test_paged_stream_asks_nothing_twice(spark, recorded, tmp_path):
    feed, log, state = (f"file://{tmp_path}/{n}" for n in ("feed", "log", "state"))
    os.makedirs(feed.removeprefix("file://"))
    all_ = names(recorded)
    for part, seen in ((all_[:2], 40), (all_[2:3], 60), (all_[4:], 60), (all_[3:4], 95)):
        for n in part:
            shutil.copy(f"{recorded}/{n}".removeprefix("file://"), feed.removeprefix("file://"))
        rows = ingest.run_available(paged.paged_stream(spark, feed, log), state)
        assert rows.count() == rows.select("id").distinct().count() == seen
    asked = [n[:12] for n in os.listdir(log.removeprefix("file://"))]
    assert len(asked) == len(set(asked)) == len(all_)
    assert {tuple(r) for r in rows.collect()} == {tuple(r) for r in paged.paged(spark, recorded).collect()}


def test_pages_that_count(spark):
    pages = [(i, "<record/>" * n + ("<nextRecordPosition>1</nextRecordPosition>" if more else "")) for i, (n, more) in enumerate([(3, 1), (4, 1), (2, 1), (5, 0), (9, 1)])]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for limit, wanted in ((100, [3, 7, 9, 14]), (8, [3, 7, 9]), (7, [3, 7])):
            df = spark.createDataFrame(pages, "page int, xml string")
            assert [r.fetched for r in files.more_pages(df, "xml", "page", limit).orderBy("page").collect()] == wanted
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_versions(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    first = versions.write_version(spark.range(5).toDF("x"), path)
    opened = versions.current(spark, path)
    versions.write_version(first.select((F.col("x") + 10).alias("x")), path)
    values = lambda df: sorted(r.x for r in df.collect())
    assert values(first) == [0, 1, 2, 3, 4] and values(versions.read_version(spark, path)) == [10, 11, 12, 13, 14]
    held, point = versions.current(spark, path), versions.point

    def stop(*_):
        raise RuntimeError("stopped between the steps")

    monkeypatch.setattr(versions, "point", stop)
    with pytest.raises(RuntimeError):
        versions.write_version(spark.range(1).toDF("x"), path)
    monkeypatch.setattr(versions, "point", point)
    assert values(versions.read_version(spark, path)) == [10, 11, 12, 13, 14]
    with pytest.raises(OSError, match="no longer counts"):
        versions.point(spark, path, opened, before=opened)
    versions.point(spark, path, opened, before=held)
    assert values(versions.read_version(spark, path)) == [0, 1, 2, 3, 4]
    last = versions.write_version(spark.createDataFrame([], "x long"), path)
    assert last.count() == 0 and len(versions.drop_versions(spark, path)) == 3 and len(versions.versions(spark, path)) == 1


def test_one_scan_writes_and_counts(spark, tmp_path):
    spark.range(100).write.parquet(f"{tmp_path}/in")
    runs = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(x):
        runs.add(1)
        return x

    rows = spark.read.parquet(f"{tmp_path}/in").select(counted("id").alias("x"))
    seen = sinks.write_observed(rows, lambda df: df.where("x >= 90").write.parquet(f"{tmp_path}/out"), all=F.count(F.lit(1)), top=F.max("x"))
    assert seen == {"all": 100, "top": 99} and runs.value == 100 and spark.read.parquet(f"{tmp_path}/out").count() == 10
    assert sinks.write_side(rows.where("x < 0"), f"{tmp_path}/none") == 0 and not os.path.exists(f"{tmp_path}/none")
    assert sinks.write_side(rows.where("x < 3"), f"{tmp_path}/side") == 3
    told = sinks.write_metadata(spark, f"{tmp_path}/meta", 50, 10, 120, start=1, limit=50, chunk=25).first()
    assert told.reached_cap and told.more_available and told.new_rows == 10
    assert not sinks.write_metadata(spark, f"{tmp_path}/meta", 50, 10, 120, start=71).first().more_available


def test_identifiers_as_state(spark, tmp_path):
    made = random.Random(4)
    groups = [(f"d{i}", f"r{made.randint(0, 12)}") for i in range(90)]
    known = spark.createDataFrame([(f"d{i}", f"K{made.randint(0, 6)}") for i in range(0, 90, 2)], "member string, stable_id string")
    schema = "member string, root string"
    wanted = {tuple(r) for r in identity.stable_ids(spark.createDataFrame(groups, schema), known, "member", "root").collect()}
    for cuts in ((0, 90), (0, 1, 50, 90)):
        source, folder = f"{tmp_path}/groups{len(cuts)}", f"file://{tmp_path}/state{len(cuts)}"
        for a, b in zip(cuts, cuts[1:]):
            spark.createDataFrame(groups[a:b], schema).coalesce(1).write.mode("append").parquet(source)
            found = identifiers.stream_ids(spark.readStream.schema(schema).parquet(source), known, folder)
        assert {tuple(r) for r in found.collect()} == wanted


def test_prefix_join(spark):
    made = random.Random(1)

    def rows(n, first):
        names = ["".join(made.choice("xy") for _ in range(made.randint(0, 7))) for _ in range(n)]
        return [(i + first, made.choice(["a", "a", "a", "b", None]), made.choice([None, "é", "éx", "éxy"]) if made.random() < 0.05 else s) for i, s in enumerate(names)]

    left, right = rows(300, 0), rows(200, 1000)
    wanted = collections.Counter()
    for i, k, s in left:
        for j, m, r in right:
            x, y = s or "", r or ""
            if (k or "") == (m or "") and (x == y or x and y and (x.startswith(y) or y.startswith(x))):
                wanted[i, j, x, y] += 1
    frames = [spark.createDataFrame(x, f"{n} long, k string, s string") for x, n in ((left, "l"), (right, "r"))]
    for coalesce in ("true", "false"):  # one range, and a key that lies in several
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        try:
            assert collections.Counter(map(tuple, prefixes.prefix_join(*frames, "l", "r", ["k"], "s").collect())) == wanted
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert prefixes.prefix_join(frames[0].limit(0), frames[1], "l", "r", ["k"], "s").count() == 0


def test_closure(spark):
    made = random.Random(2)
    links = [(made.choice([None, *range(6)]), made.choice([None, *"abcd"])) for _ in range(60)]
    counts = [(made.choice("abcdx"), made.choice(["p", "q", "", None]), made.choice([-2, 0, 3, 5, None])) for _ in range(80)]
    pairs = {x for x in links if None not in x}
    some = [c for c in counts if c[1] and c[2] and c[2] > 0]
    own = collections.Counter()
    for farm, rel in pairs:
        for r, category, n in some:
            own[farm, category] += n if r == rel else 0
    own = {k: v for k, v in own.items() if v}
    totals = collections.Counter()
    for (_, category), n in own.items():
        totals[category] += n
    args = spark.createDataFrame(links, "farm int, rel string"), spark.createDataFrame(counts, "rel string, category string, n int"), "farm", "rel", "category", "n"
    assert {tuple(r) for r in closure.closure_totals(*args).collect()} == set(totals.items())
    assert {tuple(r) for r in closure.closure_sums(*args).collect()} == {(*k, v) for k, v in own.items()}
    assert {r.farm for r in closure.closure_entities(*args).collect()} == {k[0] for k in own}
