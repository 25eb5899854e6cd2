"""Benchmark decontamination by winnowing, in DataFrame operations only.

The fingerprints of a text are, for every run of RUN = 10 words, the least hash among its five runs of six words (leftmost if they
tie), with its place. Two texts that share ten words in a row therefore share that fingerprint at the same place of the run. The
fingerprints of the documents are joined with those of the benchmark, each hit is extended to the ten words around it and compared
word by word, and the words that equal runs cover are counted. An item of fewer than ten words is one run; its hash is looked for
at every place of the documents.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeweave.operators.durable import durable

RUN, K = 10, 6
WINDOW = RUN - K + 1
#: Distinct hashes of benchmark fingerprints (8 bytes each) that are broadcast at most; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    """The words of a text column: A-Z lower-cased, runs of digits, a-z and anything beyond ASCII; none for null."""
    cut = F.split(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(cut, lambda w: w != "")


def _hashed(df: DataFrame, k: int, *keep: str) -> DataFrame:
    """keep and keys, the hashes of all runs of k words of column words (each word is hashed once)."""
    each = df.where(F.size("words") >= k).select(*keep, F.transform("words", lambda w: F.xxhash64(w)).alias("each"))
    return each.select(*keep, F.transform(F.expr(f"sequence(0, size(each) - {k})"), lambda i: F.xxhash64(*[F.get("each", i + j) for j in range(k)])).alias("keys"))


def fingerprints(df: DataFrame, *keep: str) -> DataFrame:
    """Rows (keep..., hash, place from 0) of the texts with ten words or more, from column words."""
    keyed = _hashed(df.where(F.size("words") >= RUN), K, *keep)

    def leftmost(i: Column) -> Column:
        keys = [F.get("keys", i + j) for j in range(WINDOW)]
        out = i + WINDOW - 1
        for j in range(WINDOW - 2, -1, -1):
            rest = F.least(*keys[j + 1 :]) if j < WINDOW - 2 else keys[-1]
            out = F.when(rest >= keys[j], i + j).otherwise(out)
        return out

    places = F.array_distinct(F.transform(F.expr(f"sequence(0, size(keys) - {WINDOW})"), leftmost))
    return keyed.select(*keep, F.inline(F.transform(places, lambda p: F.struct(F.get("keys", p).alias("hash"), p.alias("place")))))


def _runs_of(df: DataFrame, k: int, *keep: str) -> DataFrame:
    """Rows (keep..., hash, place) of all runs of k words."""
    return _hashed(df, k, *keep).select(*keep, F.posexplode("keys").alias("place", "hash")).select(*keep, "hash", "place")


def benchmark_runs(benchmark: DataFrame) -> DataFrame:
    """Rows (run, n, hash, offset, items): the distinct runs of all items, their fingerprint and where in the run it stands (the
    run's own hash and 0 for runs of fewer than ten words), and the sorted ids of the items that contain them."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words("text").alias("words")).where("item_id IS NOT NULL AND size(words) > 0")
    cut = F.transform(F.expr(f"sequence(1, greatest(1, size(words) - {RUN - 1}))"), lambda i: F.slice("words", i, RUN))
    runs = items.select("item_id", F.explode(cut).alias("words")).groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    long = fingerprints(runs, "words", "items").select("words", F.lit(RUN).alias("n"), "hash", F.col("place").alias("offset"), "items")
    short = runs.where(F.size("words") < RUN).select("words", F.size("words").alias("n"), "items")
    every = [long] + [_runs_of(short.where(f"n = {k}"), k, "words", "n", "items").select("words", "n", "hash", F.col("place").alias("offset"), "items") for k in range(1, RUN)]
    return reduce(DataFrame.unionByName, every).withColumnRenamed("words", "run")


def hits(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows (doc_id, digest, n, hash, place): places of docs (doc_id, digest, words) with the fingerprint of a run."""
    found = []
    for k in sorted(r["n"] for r in runs.select("n").distinct().collect()):  # at most ten lengths
        hashes = runs.where(f"n = {k}").select("hash").distinct()
        rows = fingerprints(docs, "doc_id", "digest") if k == RUN else _runs_of(docs, k, "doc_id", "digest")
        small = hashes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        found.append(rows.join(F.broadcast(hashes) if small else hashes, "hash").select("doc_id", "digest", F.lit(k).alias("n"), "hash", "place"))
    return reduce(DataFrame.unionByName, found) if found else docs.select("doc_id", "digest", F.lit(RUN).alias("n"), F.lit(0).cast("bigint").alias("hash"), F.lit(0).alias("place")).where("false")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All rows and columns of docs (doc_id, text, ...), and n_words, n_hit, n_items, items_sha256 and contaminated.

    A document word is hit if it lies in a run of ten words of a benchmark item (or in a whole item of fewer). n_items counts the
    items with such runs, items_sha256 is the digest of their ids, sorted as strings and comma-joined. Null and empty texts have no
    words and no hits. Rows that repeat a doc_id are judged by their own texts; the ids may be null. Benchmark rows without id or
    words are nothing to look for; an empty benchmark hits nothing. Columns of these names in docs are replaced.
    Long texts are compared whole; a task holds one text's words. An empty table gives an empty one.
    """
    made = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    kept = [c for c in docs.columns if c not in made]
    docs = docs.select(*kept)
    runs = durable(benchmark_runs(benchmark), "runs")
    told = docs.select("doc_id", F.xxhash64("text").alias("digest"), words("text").alias("words"))
    near = hits(told, runs).distinct().join(runs, ["n", "hash"])
    near = near.select("doc_id", "digest", F.struct((F.col("place") - F.col("offset")).alias("at"), "run", "items").alias("hit")).where("hit.at >= 0")
    near = near.groupBy("doc_id", "digest").agg(F.collect_list("hit").alias("hits"))
    near = durable(near, "hits").select(F.col("doc_id").alias("hit_doc"), F.col("digest").alias("hit_digest"), "hits")

    placed = docs.withColumns({"__digest": F.xxhash64("text")}).join(near, F.expr("doc_id <=> hit_doc AND __digest = hit_digest"), "left").withColumn("__words", words("text"))
    true = F.filter("hits", lambda h: F.slice("__words", h["at"] + 1, F.size(h["run"])) == h["run"])
    judged = placed.withColumns({"n_words": F.size("__words").cast("bigint"), "__true": F.when(F.col("hits").isNotNull(), true).otherwise(F.slice("hits", 1, 0))})
    covered = F.array_distinct(F.flatten(F.transform("__true", lambda h: F.sequence(h["at"], h["at"] + F.size(h["run"]) - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("__true", lambda h: h["items"]))))
    judged = judged.withColumns({"n_hit": F.coalesce(F.size(covered), F.lit(0)).cast("bigint"), "__items": F.coalesce(items, F.array().cast("array<string>"))})
    return judged.select(*kept, "n_words", "n_hit", F.size("__items").cast("bigint").alias("n_items"), F.sha2(F.array_join("__items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
