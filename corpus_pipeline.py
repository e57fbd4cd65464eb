"""Corpus pipeline: quality rules, line dedup, near dedup, mixing to target weights, packing into training sequences."""
from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkpack.llm import line_dedup, mixing, near_dedup, packing, quality  # noqa: E402
from sparkpack.llm.common import n_words, stage  # noqa: E402
from sparkpack.llm.queries import tokenizer_path  # noqa: E402

#: SQL can't express similarity components or packing; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.apply_quality_rules(docs).filter("kept").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines go; documents that lose all their lines go with them; n_chars follows the text."""
    out = line_dedup.remove_repeated_lines(docs)
    out = out.filter((F.col("n_removed_lines") == 0) | (F.col("n_removed_lines") < F.col("n_lines")))
    n_chars = F.when(F.col("n_removed_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return near_dedup.keep_one_of_each(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it. Rows that repeat an id, or have none, are taken each on their own."""
    rows = stage(docs.withColumn("_mix_row", F.monotonically_increasing_id()))
    slim = rows.select("_mix_row", F.col("doc_id").alias("_id"), "source", n_words(F.col("text")).alias("_size"))
    mixed = mixing.mix_sources(slim, "_id", F.col("_size"), F.array("source"), mixing.cycling_weights)
    taken = stage(mixed.filter("copies > 0").select(F.col("_mix_row").alias("_taken"), F.col("copies").alias("_copies")))
    out = rows.join(taken.hint("shuffle_hash"), rows["_mix_row"] == taken["_taken"])
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(packing.token_pieces(docs, tokenizer_path()))


STAGES = [
    ("quality_rules", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each reading what the one before wrote to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
