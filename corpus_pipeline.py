"""From documents to token ids: quality rules, exact and near duplicates, the training mix, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next
one's docs. All but the last return the columns they were given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadweave.llm.bpe import encode
from roadweave.llm.common import documents, vocabulary, with_workers
from roadweave.llm.curriculum import training_order
from roadweave.llm.exact_dedup import without_duplicates
from roadweave.llm.near_dedup import one_of_each
from roadweave.llm.quality import cleaned
from roadweave.sources.tables import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and keep enough words, without their boilerplate lines."""
    return cleaned(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest doc_id."""
    with_workers(spark)
    return without_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    with_workers(spark)
    return one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, ends: the token ids of each document, and where in its bytes each token ends."""
    with_workers(spark)
    return encode(docs, vocabulary("byte_bpe_50k.tiktoken"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("curriculum_mix", mix),
    ("byte_bpe", tokens),
]

ORACLE_SQL: str | None = None  # near duplicates and merges are beyond SQL; tests hold run() against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
