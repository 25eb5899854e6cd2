"""The operators' queries over the driver's tables, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeweave.llm import bpe, decontaminate, embeddings, html, jaccard, language, licenses, merkle, negatives, quality, token_file, urls, warc
from noticeweave.llm.oracles import ORACLES  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.token_round_trip(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_copies(_table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "threshold", "keep")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_table(spark, sf_dir, "pages"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    return judged.drop("text")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents").select("doc_id", "text"), with_ids=False)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(urls.URL_RULES, "host string, path string, verdict string")
    return urls.judge(_table(spark, sf_dir, "pages"), rules).drop("by_alias")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("url")


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict(_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).select("doc_id", "held_out", "lang_pred", "score", "languages")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    relabelled = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(relabelled, F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_token_file, op2_license_scan, op3_embedding_near_dedup, op4_quality_classifier, op5_html_extraction, op6_benchmark_decontamination, op7_ngram_jaccard_join, op8_byte_level_bpe, op9_url_filter, op10_warc, op11_language_id, op12_hard_negatives, op13_merkle_manifest, pipeline)}
