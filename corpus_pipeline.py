"""Corpus pipeline: stages over ``documents``, each written and read again.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm import bpe, decontaminate, jaccard_join, quality, substring_dedup
from stintlake.llm.common import small_batches, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's cut stay."""
    small_batches(spark)
    net = quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.select(*COLUMNS, quality.score(docs["text"], net).alias("quality_score")).filter(F.col("quality_score") >= quality.CUT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts stays, that with the smallest id."""
    small_batches(spark)
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that 13 words of an earlier document cover go; documents of which no word is left go."""
    small_batches(spark)
    kept = substring_dedup.dedup_texts(docs, carry=["lang", "source"]).filter("n_words = 0 or n_removed < n_words")
    return kept.select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of what is left, as digests."""
    import public_tokenizers

    small_batches(spark)
    return bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_free", benchmark_free),
    ("tokens", tokens),
]

#: Learned scores and tokenizers can't be written in SQL; tests/llm holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
