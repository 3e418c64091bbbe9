"""Corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``, so a lost executor or a restart costs one stage at
most. All but the last return the columns of ``documents``; the last adds ``n_tokens``,
``token_ids`` (binary, little-endian uint32) and ``decoded_sha256`` and leaves out the text.

Nulls, empty and long texts, repeated rows and empty tables have the results that the
operators' docstrings define: a null text counts as empty and fails the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.llm import bpe, chosen_path, exact_dedup, mixing, suffix_repetition
from cohortline.llm.common import col, table
from cohortline.session import scratch_dir

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")

#: Suffix arrays, Bloom filters with float statistics and token merges are not SQL.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repeated substrings."""
    return suffix_repetition.rules(docs).filter("kept").select(*[col(c) for c in docs.columns])


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, the document with the least id."""
    return chosen_path.dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by Poisson replication; sources weigh rows ** 0.7."""
    return mixing.mix(docs, mixing.temperature_weights(docs)).select(*[col(c) for c in docs.columns])


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the hash of the text decoded from them."""
    return bpe.round_trip(docs, VOCABULARY).withColumn(
        "decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256)).drop("text", "decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("source_mix", source_mix),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    base = scratch_dir(spark, "corpus-pipeline")
    for number, (name, stage) in enumerate(STAGES, 1):
        path = f"{base}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
