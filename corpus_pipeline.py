"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and its whole input; all but the last
return the columns of `documents`. Between stages the rows are written as Parquet
to the shared folder and read again.

Odd rows have a defined way through. Texts that are null, empty or blank fail the base
rule of the first stage and go there; given to a later stage they pass: they are no
duplicates, hold no personal data, cost the mixture nothing and pack as the closing
token alone. A null doc_id is a document like any other and orders last (first in the
mixture's order). Rows that repeat id and text are one document to the second stage,
which keeps one, and are taken or left together by the fourth. Extra columns of any name
come through unchanged up to the last stage. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quarrylake.llm import mixing, neardup, packing, pii, quality
from quarrylake.llm.common import release, stored
from quarrylake.llm.queries import MIX


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie far from their group's bulk go."""
    return quality.reject_outliers(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays."""
    return neardup.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by the name of its kind."""
    return pii.redact(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are drawn to their weights; a document drawn in two epochs is two rows."""
    return mixing.mix(docs, **MIX)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids, each with its sequence and offset."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mixture", source_mixture),
    ("packed_sequences", packed_sequences),
]

# Covariance estimates, learned contexts and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        release(spark)
    return docs
