"""Registered queries of the training-data operators."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpack.llm import (divergence, extraction, language, line_dedup, mixing, near_dedup, packing, pii, quality,
                           resampling, sharding, toxicity, vector_dedup)
from sparkpack.llm.common import n_words, stage
from sparkpack.llm.oracle import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file, installed with Python on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


@_query
def op1_sharding(spark: SparkSession, d: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _documents(spark, d).select("doc_id", "source", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    out = sharding.interleave_shards(rows, "doc_id", "source", 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op2_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, d), words=3, percent=85)


@_query
def op3_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.remove_repeated_lines(_documents(spark, d)).select("doc_id", "n_lines", "n_removed_lines", "text")


@_query
def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(packing.token_pieces(_documents(spark, d), tokenizer_path()))


@_query
def op5_vector_dedup(spark: SparkSession, d: str) -> DataFrame:
    return vector_dedup.near_vectors(spark.read.parquet(f"{d}/embeddings.parquet"))


def _held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


@_query
def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    profiles = language.learn_profiles(docs.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2))
    return language.identify_languages(docs, profiles, _held_out())


@_query
def op7_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.apply_quality_rules(_documents(spark, d)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query
def op8_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    labels = spark.read.parquet(f"{d}/labels.parquet").filter("toxic is not null")
    labels = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select(F.col("doc_id").alias("_id"), "toxic")
    labelled = docs.select("doc_id", "text").join(labels.hint("shuffle_hash"), F.col("doc_id") == F.col("_id")).select("toxic", "text")
    labelled = stage(labelled)
    return toxicity.score_toxicity(docs, toxicity.fit(labelled), _held_out()).drop("passages")


@_query
def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", "source", n_words(F.col("text")).alias("size"))
    mixed = mixing.mix_sources(docs, "doc_id", F.col("size"), F.array("source"), mixing.cycling_weights)
    wanted = F.broadcast(mixing.source_targets(docs, "size", "source", mixing.cycling_weights))
    out = mixed.join(wanted, mixed["source"].eqNullSafe(wanted["_source"]))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query
def op10_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_personal_data(_documents(spark, d))


@_query
def op11_source_audit(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit_sources(_documents(spark, d))


@_query
def op12_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


@_query
def op13_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    return extraction.extract_pages(spark.read.parquet(f"{d}/pages.parquet"))


@_query
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    """The whole corpus pipeline at the repository top."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, d)
