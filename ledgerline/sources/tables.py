"""Table reads: whole, pruned, and with a stable row id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.sizing import lookup_join, measured
from ledgerline.operators.quality import require_columns


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_pruned(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Chosen columns only; the scan reads no others."""
    df = spark.read.parquet(path)
    require_columns(df, columns)
    return df.select(*columns)


def scan_with_row_id(spark: SparkSession, path: str, row_id: str = "source_row_id") -> DataFrame:
    """Position in the table as the first column: the rows of the files before, in the order
    of their paths, and the position in the file. Unique over all files.

    The files' row counts come from their footers; the sums are one row per file.
    """
    rows = spark.read.parquet(path)
    files = rows.groupBy(F.col("_metadata.file_path").alias("_file")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_file")) - F.col("_rows")
    offsets = measured(files.select("_file", before.alias("_before")))
    placed = rows.select(F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"), "*")
    joined = lookup_join(placed, offsets, ["_file"])
    return joined.select((F.col("_before") + F.col("_index")).alias(row_id), *rows.columns)


def scan_with_file_row_id(spark: SparkSession, path: str) -> DataFrame:
    """source_file and source_row_id, unique over all files of a table."""
    return spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("source_row_id"),
        "*",
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
