"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bayline.llm import (
    bpe, chats, collocations, divergence, fingerprints, lm_scoring, mixing, near_dups, neighbours, oracle, packing, quality,
    secrets, token_counts,
)
from bayline.llm.common import table


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chats.formatted(table(spark, sf_dir, "conversations"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.components(table(spark, sf_dir, "documents"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.scan(docs, secrets.learn(docs))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1,
    "op2_token_counts": op2,
    "op3_best_fit_packing": op3,
    "op4_source_mixing": op4,
    "op5_nearest_neighbours": op5,
    "op6_document_fingerprints": op6,
    "op7_chat_formatting": op7,
    "op8_lm_scoring": op8,
    "op9_near_duplicates": op9,
    "op10_secret_scans": op10,
    "op11_collocations": op11,
    "op12_source_divergence": op12,
    "op13_bpe_encoding": op13,
}

ORACLE: dict[str, str] = {
    "op4_source_mixing": oracle.MIX,
    "op7_chat_formatting": oracle.CHATS,
    "op9_near_duplicates": oracle.NEAR_DUPS,
    "op11_collocations": oracle.COLLOCATIONS,
    "op12_source_divergence": oracle.DIVERGENCE,
}
