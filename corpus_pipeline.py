"""From raw documents to packed token sequences, stage by stage.

Each stage takes all rows that its predecessor kept, read again from Parquet
when a caller writes them in between, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopsight.llm import jaccard, mixing, packing, pii, quality
from shopsight.llm.common import cut, ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    ship(spark)
    return quality.keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: five-word shingles, 0.8."""
    ship(spark)
    return jaccard.keep_one(docs, rule=jaccard.Join(shingle=5, percent=80))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that reveal it are masked in the text."""
    ship(spark)
    return pii.sanitise(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mixture draws them; the budget gives every source
    one whole epoch at least, so no document is left out."""
    ship(spark)
    return mixing.mix(docs, mixing.Target(max_repetition=1.5))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("packing", sequence_packing),
]

#: SQL can't express the tokenizer's ids or Spark's random permutations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))  # each stage reads its input several times
    return STAGES[-1][1](spark, docs, sf_dir)
