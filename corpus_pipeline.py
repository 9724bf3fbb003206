"""A training corpus from documents, in stages that are each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trolley.functions.scratch import scratch_path
from trolley.llm import bpe, lsh_forest, mixing, ordinal_quality, suffix_dedup
from trolley.llm.common import read_table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier keeps; it learns from the labels of documents that are here."""
    return ordinal_quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return lsh_forest.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated strings; no document goes."""
    return suffix_dedup.without_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight wants; each at least once."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document and their digests; one row per row of ``docs``."""
    return bpe.round_trip_digest(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("mixing sources to target weights", mixed),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

#: SQL can't express the classifier, the signatures and the tokenizer: tests compare each stage with
#: a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
