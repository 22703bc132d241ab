"""Result records, their validation, and the leaderboard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators.evaluation import METRICS

# The field names of a result record.
RESULT_SCHEMA = T.StructType([
    T.StructField("experiment_id", T.StringType()),
    T.StructField("author", T.StringType()),
    T.StructField("target", T.StringType()),
    T.StructField("metrics", T.StructType([T.StructField(m, T.DoubleType()) for m in METRICS])),
    T.StructField("data", T.StructType([
        T.StructField("train_rows", T.LongType()),
        T.StructField("test_rows", T.LongType()),
        T.StructField("excluded_test_rows", T.LongType()),
        T.StructField("split_id", T.StringType()),
        T.StructField("leakage_check", T.BooleanType()),
    ])),
    T.StructField("fare_bands", T.ArrayType(T.StructType([
        T.StructField("fare_band", T.StringType()),
        T.StructField("rows", T.LongType()),
        *[T.StructField(m, T.DoubleType()) for m in METRICS],
    ]))),
    T.StructField("artifacts", T.StructType([
        T.StructField("report", T.StringType()),
        T.StructField("model", T.StringType()),
    ])),
])


def result_violations(records: DataFrame, author: str | None = None) -> DataFrame:
    """experiment_id, author, problem: one row per broken rule of a record."""
    def check(condition, text):
        return F.when(condition, F.lit(text))

    problems = [check(F.col(c).isNull(), f"{c} is missing") for c in ("experiment_id", "author", "target", "metrics", "data")]
    problems += [check(F.col(f"metrics.{m}").isNull() & F.col("metrics").isNotNull(), f"metrics.{m} is missing") for m in METRICS]
    problems += [check(F.col(c) == "", f"{c} is empty") for c in ("experiment_id", "author")]
    if author is not None:
        problems.append(check(F.col(author) != F.col("author"), "author differs from its folder"))
    # The checks read nested fields, so they are columns before the generator reads them.
    checked = records.select("experiment_id", "author", F.array_compact(F.array(*problems)).alias("problems"))
    return checked.select("experiment_id", "author", F.explode("problems").alias("problem"))


def require_valid_results(records: DataFrame, author: str | None = None) -> None:
    """Raises with the number of records that break each rule, and one author per rule."""
    broken = result_violations(records, author).groupBy("problem").agg(
        F.count("*").alias("n"), F.min("author").alias("author")
    ).orderBy("problem").collect()
    if broken:
        raise ValueError(f"invalid result records: {[(r['problem'], r['n'], r['author']) for r in broken]}")


def scan_results_json(spark: SparkSession, folder: str) -> DataFrame:
    """Records of ``<folder>/<author>/metrics.json`` with their folder and source path."""
    read = spark.read.schema(RESULT_SCHEMA).option("multiLine", True).json(f"{folder}/*/metrics.json")
    parts = F.split(F.col("_metadata.file_path"), "/")
    return read.select(
        "*",
        F.col("_metadata.file_path").alias("source"),
        F.element_at(parts, -2).alias("folder_author"),
    )


def load_results(spark: SparkSession, folder: str) -> DataFrame:
    """Validated records; a record under another author's folder is an error."""
    records = scan_results_json(spark, folder)
    if records.isEmpty():
        raise FileNotFoundError(f"no metrics.json under {folder}")
    require_valid_results(records, "folder_author")
    return records


def leaderboard(
    records: DataFrame, target: str, split_id: str, test_rows: int, source: str | None = None
) -> DataFrame:
    """Flat, ranked comparison: eligible records first, then by mean absolute error."""
    def known(condition):
        return F.coalesce(condition, F.lit(False))

    leakage = F.coalesce(F.col("data.leakage_check"), F.lit(False))
    eligible = (
        known(F.col("target") == target)
        & leakage
        & known(F.col("data.split_id") == split_id)
        & known(F.col("data.test_rows") == test_rows)
        & known(F.col("data.excluded_test_rows") == 0)
    )
    flat = records.select(
        "author", "experiment_id", "target",
        *[F.col(f"metrics.{m}").alias(m) for m in METRICS],
        *[F.col(f"data.{c}").alias(c) for c in ("train_rows", "test_rows", "excluded_test_rows")],
        leakage.alias("leakage_check"),
        eligible.alias("eligible"),
        *([F.col(source).alias("source")] if source else []),
    )
    return leaderboard_rank(flat)


def leaderboard_rank(flat: DataFrame) -> DataFrame:
    """1-based rank of a leaderboard: one row per experiment, so one small window."""
    order = [F.desc("eligible"), F.asc_nulls_last("mae"), F.asc("author"), F.asc("experiment_id")]
    return flat.withColumn("rank", F.row_number().over(Window.orderBy(*order))).orderBy("rank")


def best_by_metric(metrics: DataFrame, name: str, metric: str = "mae", exclude: Sequence[str] = ()) -> DataFrame:
    """The row with the lowest metric among the candidates."""
    candidates = metrics.where(~F.col(name).isin(*exclude)) if exclude else metrics
    return candidates.orderBy(F.asc_nulls_last(metric), name).limit(1)


def metric_sort(metrics: DataFrame, metric: str = "r2") -> DataFrame:
    return metrics.orderBy(F.desc_nulls_last(metric))


def metrics_record(
    metrics: DataFrame, bands: DataFrame | None, experiment_id: str, author: str, target: str,
    train_rows: int, test_rows: int, split_id: str, leakage_check: bool,
    excluded_test_rows: int = 0, report: str | None = None, model: str | None = None,
) -> DataFrame:
    """One nested record of a run, in the shape of ``RESULT_SCHEMA``.

    ``metrics`` is the one-row output of ``regression_metrics``; ``bands`` the few rows of
    ``band_metrics``.
    """
    record = metrics.select(F.struct(*METRICS).alias("metrics"))
    if bands is None:
        listed = F.lit(None).cast(RESULT_SCHEMA["fare_bands"].dataType)
    else:
        band = F.struct(F.col("band").alias("fare_band"), F.col("row_count").alias("rows"), *METRICS)
        listed = bands.agg(F.sort_array(F.collect_list(band))).scalar()
    record = record.withColumn("fare_bands", listed)
    return record.select(
        F.lit(experiment_id).alias("experiment_id"),
        F.lit(author).alias("author"),
        F.lit(target).alias("target"),
        "metrics",
        F.struct(
            F.lit(train_rows).cast("long").alias("train_rows"),
            F.lit(test_rows).cast("long").alias("test_rows"),
            F.lit(excluded_test_rows).cast("long").alias("excluded_test_rows"),
            F.lit(split_id).alias("split_id"),
            F.lit(leakage_check).alias("leakage_check"),
        ).alias("data"),
        "fare_bands",
        F.struct(
            F.lit(report).cast("string").alias("report"), F.lit(model).cast("string").alias("model")
        ).alias("artifacts"),
    )
