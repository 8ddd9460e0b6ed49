"""From raw documents to token ids: the training-data operators as one pipeline."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tramflow.llm import byte_bpe, mixing, probminhash, quality_mil, suffix_dedup
from tramflow.llm.common import labels
from tramflow.session import ensure_checkpoint_dir

#: Length of the strings that the suffix stage removes: less than 50 words of prose take, so a shared passage
#: of 50 words goes whatever its words are, and a shared line of some thirty words stays.
REPEATED_BYTES = 200

#: The stages judge texts by models, signatures and byte strings, which SQL cannot express.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_mil.accepted(docs, labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return probminhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of repeated strings of ``REPEATED_BYTES``."""
    return suffix_dedup.without_repeats(docs, REPEATED_BYTES)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, their hash and that of the decoded text."""
    return byte_bpe.encoded(docs, public_tokenizers.path(byte_bpe.VOCABULARY), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("near_dedup", near_dedup),
    ("suffix_dedup", repeats),
    ("mixing", mix),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written to the shared checkpoint folder and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{at}")
        docs = spark.read.parquet(f"{folder}/{at}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
