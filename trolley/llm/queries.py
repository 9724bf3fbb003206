"""One query per operator of this package, over whole tables, and the SQL of those SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from trolley.llm import audit, bpe, hilbert, language, lemp, lsh_forest, mixing, ordinal_quality, simhash_trie, suffix_dedup, syncmers, token_planes, toxicity
from trolley.llm.common import read_table


def op1_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return token_planes.stored_digest(documents, public_tokenizers.path("byte_bpe_50k.json"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.held_out_predictions(read_table(spark, sf_dir, "documents"))


def op3_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.every_twentieth(read_table(spark, sf_dir, "embeddings"))


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_report(read_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return toxicity.held_out_scores(documents, labels)


def op6_lsh_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(read_table(spark, sf_dir, "documents"))


def op8_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return ordinal_quality.rate(documents, labels)


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_likeness(read_table(spark, sf_dir, "documents"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return bpe.round_trip_digest(documents, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op11_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lemp.of_every_hundredth(read_table(spark, sf_dir, "embeddings"))


def op12_conversation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.damaged_and_repaired(read_table(spark, sf_dir, "conversations"))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_planes": op1_token_planes,
    "op2_language_id": op2_language_id,
    "op3_hilbert_neighbours": op3_hilbert_neighbours,
    "op4_temperature_mixing": op4_temperature_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_lsh_forest_join": op6_lsh_forest_join,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_ordinal_quality": op8_ordinal_quality,
    "op9_syncmers": op9_syncmers,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lemp_negatives": op11_lemp_negatives,
    "op12_conversation_audit": op12_conversation_audit,
    "op13_simhash_trie": op13_simhash_trie,
}
ORACLE_SQL = {"op4_temperature_mixing": mixing.ORACLE_SQL, "op11_lemp_negatives": lemp.ORACLE_SQL}
