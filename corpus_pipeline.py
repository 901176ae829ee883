"""From raw documents to packed training sequences, in five stages over the whole corpus.

Each stage reads what the one before it wrote, as Parquet, and returns the columns of `documents`;
the last returns the packed pieces. ORACLE_SQL is None: SQL can't express a learned classifier, so
the stages are tested against brute-force versions.

Defined cases: null and empty texts are scored, link with nothing, hold no secret, and are one closing
id when packed; rows with a null id are kept by every stage that accepts their text; of rows that share
an id, unlike ones are decided each and like ones leave one; repeated rows are like ones; extra columns
pass through all stages but the last; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bayline.llm import mixing, near_dups, packing, quality, secrets
from bayline.llm.common import stage, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return near_dups.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts masked."""
    return secrets.redact(docs, secrets.learn(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of smaller sources up to twice."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
