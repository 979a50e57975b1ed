"""A training corpus from ``documents``: language, exact and near copies, mix, packing.

Each stage takes the documents its predecessor kept and, but for the last,
returns documents with their columns. A stage's result is written to the
shared folder and read again as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidings.llm import exact_dedup, language_id, mixing, near_dedup, packing
from tidings.session import written

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; those without letters, or of unknown
    n-grams, go."""
    return language_id.accepted(docs, language_id.fit(docs.where(~language_id.held_out())))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.survivors(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return near_dedup.survivors(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask for."""
    return mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    return packing.pack(packing.pieces(docs, TOKENIZER))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# No SQL expresses n-gram filters, sketches or token ids.
ORACLE_SQL = None
