"""Grouped summaries and the tables behind charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expressions import WEEKDAY_LABELS, label_lookup, row_sum
from ledgerline.functions.quantiles import quantile_table
from ledgerline.operators.quality import _unpivot_row


def hourly_amount(df: DataFrame, ts: str, amount: str, hour: str = "pickup_hour") -> DataFrame:
    """Per hour: mean, exact median and row count of an amount."""
    hourly = df.select(F.hour(ts).alias(hour), amount)
    means = hourly.groupBy(hour).agg(F.avg(amount).alias("mean_amount"), F.count("*").alias("row_count"))
    medians = quantile_table(hourly, amount, [0.5], [hour]).select(
        hour, F.col("q0").alias("median_amount")
    )
    return means.join(medians, hour, "left").select(
        hour, "mean_amount", "median_amount", "row_count"
    ).orderBy(hour)


def hourly_volume(df: DataFrame, ts: str, means: Mapping[str, str], hour: str = "pickup_hour") -> DataFrame:
    """Per hour: row count and the mean of several columns."""
    return (
        df.groupBy(F.hour(ts).alias(hour))
        .agg(F.count("*").alias("row_count"), *[F.avg(c).alias(name) for name, c in means.items()])
        .orderBy(hour)
    )


def weekday_hour_amount(df: DataFrame, ts: str, parts: Sequence[str]) -> DataFrame:
    """Per (weekday, hour): mean and non-null count of the sum of parts, with the weekday name."""
    total = row_sum(parts, nulls="any")
    return (
        df.groupBy(F.weekday(ts).alias("pickup_weekday"), F.hour(ts).alias("pickup_hour"))
        .agg(F.avg(total).alias("mean_sum"), F.count(total).alias("sum_count"))
        .withColumn("weekday", label_lookup("pickup_weekday", WEEKDAY_LABELS))
        .orderBy("pickup_weekday", "pickup_hour")
    )


def code_counts(df: DataFrame, code: str, labels: Mapping | None = None, default: str = "Other") -> DataFrame:
    """Rows per code, most frequent first, with a label."""
    counted = df.where(F.col(code).isNotNull()).groupBy(code).agg(F.count("*").alias("row_count"))
    if labels is not None:
        counted = counted.withColumn("label", label_lookup(code, labels, default))
    return counted.orderBy(F.desc("row_count"), code)


def group_mean(df: DataFrame, group: Column, value: str, labels: Mapping, name: str = "group") -> DataFrame:
    """Mean of a column per labelled group."""
    return df.groupBy(label_lookup(group, labels).alias(name)).agg(F.avg(value).alias("mean_value"))


def component_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """component, mean_value, highest first."""
    row = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)])
    fields = {"mean_value": {c: f"_m{i}" for i, c in enumerate(columns)}}
    return _unpivot_row(row, fields, "component").orderBy(F.desc("mean_value"), "component")


def zero_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of zeros per column over all rows (null counts as non-zero), highest first."""
    row = df.agg(*[
        F.avg(F.coalesce(F.col(c) == 0, F.lit(False)).cast("int")).alias(f"_z{i}")
        for i, c in enumerate(columns)
    ])
    fields = {"zero_ratio": {c: f"_z{i}" for i, c in enumerate(columns)}}
    return _unpivot_row(row, fields, "component").orderBy(F.desc("zero_ratio"), "component")


def nonzero_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """On non-null rows: row count, mean, and share that is not zero, per column."""
    aggregates = []
    for i, c in enumerate(columns):
        aggregates += [
            F.count(c).alias(f"_n{i}"),
            F.avg(c).alias(f"_m{i}"),
            F.avg((F.col(c) != 0).cast("int")).alias(f"_r{i}"),
        ]
    fields = {
        "row_count": {c: f"_n{i}" for i, c in enumerate(columns)},
        "mean_value": {c: f"_m{i}" for i, c in enumerate(columns)},
        "nonzero_rate": {c: f"_r{i}" for i, c in enumerate(columns)},
    }
    return _unpivot_row(df.agg(*aggregates), fields, "component")


def target_moments(df: DataFrame, split: str, target: str) -> DataFrame:
    """Rows, mean and maximum of the target per split side."""
    return df.groupBy(split).agg(
        F.count("*").alias("row_count"),
        F.avg(target).alias("target_mean"),
        F.max(target).alias("target_max"),
    )


def macro_average(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean of metric columns over the targets of a metrics table."""
    return metrics.agg(F.count("*").alias("targets"), *[F.avg(c).alias(c) for c in columns])


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """bin, bin_start, bin_end, row_count for equal-width bins of [low, high]; empty bins show 0.

    The right edge belongs to the last bin; values outside are not counted.
    """
    width = (high - low) / bins
    c = F.col(value)
    index = F.least(F.floor((c - low) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counted = df.where(c.between(low, high)).groupBy(index.alias("bin")).agg(F.count("*").alias("_n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        frame.join(counted, "bin", "left")
        .select(
            "bin",
            (F.lit(low) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(low) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            F.coalesce("_n", F.lit(0)).alias("row_count"),
        )
        .orderBy("bin")
    )
