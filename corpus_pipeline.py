"""A training corpus from ``documents``: rules, line dedup, near-dedup, mixing, packing.

Each stage takes the rows of the one before, written as Parquet and read again. All but the
last return the columns of ``documents``; the last returns the place of every piece of every
remaining document in sequences of 1024 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import genetic, line_dedup, mixing, quality_rules, simhash
from ledgerline.llm.common import documents, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return quality_rules.passing(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly repeat an earlier one; ``n_chars`` follows the text."""
    return line_dedup.without_similar_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by SimHash fingerprints at two or fewer bits."""
    return simhash.one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that sources, languages and topics have their target shares of words."""
    return mixing.sampled(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into as few sequences as the islands find."""
    return genetic.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("mixing", mixture),
    ("best_fit_packing", packing),
]
ORACLE_SQL = None  # SQL has neither the components nor the islands; tests/llm/test_pipeline.py checks the rows


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole corpus."""
    rows = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        rows = stored(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
