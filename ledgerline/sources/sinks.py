"""Writers. Each writes in parallel; the reader gives the written table back."""

from __future__ import annotations

from copy import deepcopy

from pyspark.sql import DataFrame, SparkSession

from ledgerline.operators.results import RESULT_SCHEMA, require_valid_results


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Parquet with zstd; nullability and types survive the round trip."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """CSV with a header, read back with the schema of the table."""
    df.write.mode(mode).option("header", True).csv(path)
    return df.sparkSession.read.schema(df.schema).option("header", True).csv(path)


def sink_json(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """One JSON object per line, read back with the schema of the table."""
    df.write.mode(mode).json(path)
    return df.sparkSession.read.schema(df.schema).json(path)


def save_results(records: DataFrame, path: str) -> DataFrame:
    """Validated result records, one folder per author, read back."""
    require_valid_results(records)
    foldered = records.withColumn("author_folder", records["author"])
    foldered.write.mode("overwrite").partitionBy("author_folder").json(path)
    return load_saved_results(records.sparkSession, path)


def load_saved_results(spark: SparkSession, path: str) -> DataFrame:
    """Records written by ``save_results``; one in another author's folder is an error."""
    read = spark.read.schema(deepcopy(RESULT_SCHEMA).add("author_folder", "string")).json(path)
    require_valid_results(read, "author_folder")
    return read.drop("author_folder")
