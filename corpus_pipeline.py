"""Corpus pipeline: toxic documents go, then copies, near copies and repeated passages; what is left is packed.

Each stage works on all that the one before kept; its result is written and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewright.llm import exact_dedup, minhash, packing, substring_dedup, toxicity
from lakewright.scratch import stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near copies the one with the smallest id stays."""
    return minhash.drop_near_copies(docs)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds too are cut out of the texts; all documents stay."""
    return substring_dedup.strip_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, as query op9 gives it."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_dedup", drop_near_copies),
    ("substring_dedup", strip_repeats),
    ("packing", pack),
]

#: A trained classifier and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
