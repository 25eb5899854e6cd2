"""Documents to token ids: quality, near copies, benchmark passages, byte-level BPE. Each stage's rows are written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeweave.llm import bpe, decontaminate, jaccard, quality
from noticeweave.operators.durable import drop_durable, durable, scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _through(docs: DataFrame, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that stage keeps of docs, with exactly the columns of docs: those that the stage does not read go through it under other
    names, so none of them clashes with what it adds."""
    names = {c: f"__kept_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang")}
    return stage(docs.withColumnsRenamed(names)).select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the n-gram models of trusted text reject.

    Null and empty texts go. Null languages are a language of their own; languages without trusted text stay. Rows that repeat are judged
    alike, so all of them stay or go. An empty table gives an empty one.
    """
    labels = _table(spark, sf_dir, "labels")
    return _through(docs, lambda own: quality.quality(own, labels).where("keep"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents one row: of the smallest doc_id (null ids come last; of several texts with that id the one
    with the smallest digest), and of rows that repeat id and text any one.

    Null texts and texts without words are in no group, and all of their rows stay. An empty table gives an empty one.
    """
    groups = durable(jaccard.jaccard_components(docs.select("doc_id", "text")), "groups")
    grouped = groups.where("component IS NOT NULL").groupBy("component", "doc_id", "digest").agg(F.count("*").alias("times"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest", "times")).alias("first")
    chosen = grouped.groupBy("component").agg(least).select(F.col("first.doc_id").alias("__id"), F.col("first.digest").alias("__digest"), F.col("first.times").alias("__times"))
    alone = groups.where("component IS NULL").select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.lit(1).cast("long").alias("__times")).distinct()
    kept = docs.withColumn("__own", F.xxhash64("text")).join(chosen.unionByName(alone), F.expr("doc_id <=> __id AND __own = __digest"))
    once, repeated = kept.where("__times = 1"), kept.where("__times > 1").dropDuplicates(["doc_id", "__own"])
    return once.unionByName(repeated).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten words in a row of a benchmark item (or the whole of a shorter one).

    Null and empty texts stay; rows that repeat are judged by their own texts, null ids too. An empty table or benchmark drops nothing.
    """
    items = _table(spark, sf_dir, "benchmark")
    return _through(docs, lambda own: decontaminate.contamination(own, items).where("NOT contaminated"))


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids of what is left, their number, and digests of the ids and of the decoded bytes.

    Null texts are empty and have no ids; every row gives one, repeats too; further columns go. An empty table gives an empty one.
    """
    return bpe.encode_decode(docs, keep=["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_level_bpe),
]

#: The language models, the components and the merges are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scratch(spark) as kept:  # what a stage has written goes once its result is there
            before, docs = docs, durable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            kept.append(docs)
        drop_durable(before)
    return docs
