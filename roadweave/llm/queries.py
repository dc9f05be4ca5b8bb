"""The registered queries: each operator over its whole table, with the columns its contract names first."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadweave.llm.bitplanes import read_files, write_files
from roadweave.llm.bpe import decode, encode, ids_digest
from roadweave.llm.common import documents, embeddings, pages, vocabulary
from roadweave.llm.curriculum import mixed
from roadweave.llm.exact_dedup import exact_duplicates
from roadweave.llm.hard_negatives import hard_negatives
from roadweave.llm.html_text import extract
from roadweave.llm.language import predict, train
from roadweave.llm.near_dedup import near_duplicates
from roadweave.llm.pseudonyms import KEY_SETTING, pseudonymised
from roadweave.llm.quality import judged
from roadweave.llm.sharding import sharded
from roadweave.llm.spelling import variants
from roadweave.llm.spelling import vocabulary as spelled
from roadweave.llm.top_k import nearest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
END_ID = 2
# For trial runs on made-up tables, where the session sets no key. It is no secret.
TRIAL_KEY = "roadweave trial key, not secret"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents, by a minimal perfect hash over the history's digests."""
    return exact_duplicates(documents(spark, sf_dir))


@query
def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the target weights, with their training position."""
    return mixed(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies", "position"
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query
def op5_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency for all documents."""
    return judged(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_boilerplate_words",
    )


@query
def op6_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 contiguous shards of the smallest feasible capacity."""
    return sharded(documents(spark, sf_dir))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by byte-level BPE, and the bytes they decode to, as digests."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    return decode(encode(documents(spark, sf_dir), path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest().alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query
def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents, by an LSH forest."""
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


@query
def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal numbers, dates and addresses replaced by format-preserving pseudonyms."""
    return pseudonymised(documents(spark, sf_dir), spark.conf.get(KEY_SETTING, TRIAL_KEY))


@query
def op3_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages, by line-block distribution."""
    return extract(pages(spark, sf_dir))


@query
def op8_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents written as compressed bit planes and read back."""
    files = write_files(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), END_ID)
    return read_files(files)


@query
def op9_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, by code lengths of context trees trained on a bounded sample."""
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs))


@query
def op11_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents, the form each is a variant of, and the root of its forms."""
    return variants(spelled(documents(spark, sf_dir)))


@query
def op12_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best scores of every hundredth vector among all others, by a bit-sliced index."""
    return nearest(embeddings(spark, sf_dir))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all others, by a secondary sort."""
    return hard_negatives(embeddings(spark, sf_dir))
