"""The joins behind lookups: per-group statistics and one-row statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.sizing import lookup_join, measured


def apply_group_stats(
    train: DataFrame, rows: DataFrame, key: str, targets: Mapping[str, str]
) -> DataFrame:
    """Training mean of the row's group for each output -> target column.

    An unknown group gets the overall training mean, which follows from the group sums, so
    the training rows are read once.
    """
    aggregates = []
    for i, target in enumerate(targets.values()):
        aggregates += [F.count(target).alias(f"_n{i}"), F.sum(target).alias(f"_s{i}")]
    sums = measured(train.groupBy(key).agg(*aggregates))
    overall = sums.agg(*[
        (F.sum(f"_s{i}") / F.nullif(F.sum(f"_n{i}"), F.lit(0))).alias(f"_m{i}") for i in range(len(targets))
    ]).first()
    stats = sums.where(F.col(key).isNotNull())
    joined = lookup_join(rows, stats, [key])
    means = {
        output: F.coalesce(F.col(f"_s{i}") / F.nullif(F.col(f"_n{i}"), F.lit(0)), F.lit(overall[f"_m{i}"]))
        for i, output in enumerate(targets)
    }
    return joined.withColumns(means).drop(*[c for c in sums.columns if c != key])


def above_mean(df: DataFrame, value: str) -> DataFrame:
    """Rows above the column's mean: a scalar subquery, no join."""
    mean = df.agg(F.avg(value)).scalar()
    return df.where(F.col(value) > mean)
