"""The operators' queries over the test tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import (
    genetic, hard_negatives, hilbert, language, line_dedup, mixing, packing, prefix_trie, quality_model, quality_rules, repeats,
    simhash, sketches,
)
from ledgerline.llm.common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql.strip()
        return build

    return register


@query("op9_quality_rules", quality_rules.SQL)
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdict of every document; its source is the host."""
    return quality_rules.report(documents(spark, folder))


@query("op6_fingerprints")
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Bottom-k sketches of every document and its edited text."""
    return sketches.fingerprint_edits(documents(spark, folder))


@query("op7_simhash")
def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """SimHash of every document and the group of documents it links to."""
    return simhash.report(documents(spark, folder))


@query("op3_language")
def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those outside fold 1 of 3."""
    return language.report(documents(spark, folder))


@query("op10_quality_model")
def op10_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from labels outside fold 2 of 4."""
    return quality_model.report(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query("op1_packed_matrix")
def op1_packed_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """All documents as rows of a token matrix, packed by best fit decreasing."""
    return packing.packed_matrix(documents(spark, folder))


@query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Place of every piece of every document in sequences of 1024 tokens."""
    return genetic.pack_documents(documents(spark, folder))


@query("op5_repeats")
def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without byte strings that start earlier."""
    return repeats.report(documents(spark, folder))


@query("op2_mixing")
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Raked weight and sampling probability of every document."""
    return mixing.report(documents(spark, folder))


@query("op4_line_dedup", line_dedup.SQL)
def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of every document that nearly repeat an earlier line."""
    return line_dedup.report(documents(spark, folder))


@query("op11_prefix_trie")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    return prefix_trie.report(spark.read.parquet(f"{folder}/conversations.parquet"))


@query("op12_hard_negatives", hard_negatives.SQL)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """The best rows of other labels in a window below each positive's score."""
    return hard_negatives.report(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query("op13_hilbert_shards")
def op13_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document along the curve through its metadata."""
    return hilbert.report(documents(spark, folder))
