"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramflow.llm import byte_bpe, collinear, fingerprints, mixing, probminhash, quality_mil, rule_cascade, suffix_dedup, token_align, token_counts, token_store, toxicity_cnn, vector_codes
from tramflow.llm.common import documents, labels
from tramflow.session import ensure_checkpoint_dir


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edit_study(documents(spark, sf_dir))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(documents(spark, sf_dir), public_tokenizers.path(byte_bpe.VOCABULARY))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encoded(documents(spark, sf_dir), public_tokenizers.path(byte_bpe.VOCABULARY))


def op4_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.scored(documents(spark, sf_dir), labels(spark, sf_dir))


def op5_collinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collinear.passages(documents(spark, sf_dir))


def op6_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_cnn.scored(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removals(documents(spark, sf_dir))


def op9_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_cascade.cascade(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.aligned(documents(spark, sf_dir), public_tokenizers.path(token_align.VOCABULARY_A), public_tokenizers.path(token_align.VOCABULARY_B))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.coded(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{ensure_checkpoint_dir(spark)}/token-store-{uuid.uuid4().hex}"
    token_store.write(documents(spark, sf_dir), folder, public_tokenizers.path(token_store.VOCABULARY))
    return token_store.read(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_fingerprints, op2_token_counts, op3_byte_bpe, op4_quality_mil, op5_collinear, op6_toxicity_cnn, op7_probminhash, op8_suffix_dedup, op9_rule_cascade, op10_mixing, op11_token_align, op12_vector_codes, op13_token_store)}


def oracle_sql() -> dict[str, str]:
    return {"op9_rule_cascade": rule_cascade.ORACLE, "op10_mixing": mixing.ORACLE}
