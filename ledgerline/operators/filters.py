"""Row filters. Plain predicates reach the Parquet scan; quantile filters take two steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expressions import (
    all_of,
    nonnegative_or_null,
    not_code_or_null,
    within_limits_or_null,
)
from ledgerline.functions.quantiles import quantile_values


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def in_period(ts: str, start: str, end: str) -> Column:
    """start <= ts < end."""
    return (F.col(ts) >= _moment(start)) & (F.col(ts) < _moment(end))


def period_filter(df: DataFrame, ts: str, start: str, end: str, fail_if_empty: bool = False) -> DataFrame:
    """Rows of a half-open period."""
    kept = df.where(in_period(ts, start, end))
    if fail_if_empty and kept.isEmpty():
        raise ValueError(f"no rows between {start} and {end}")
    return kept


def positive_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull() & (F.col(target) > 0) & ~F.isnan(target))


def range_filters(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows inside every closed range; null fails."""
    return df.where(all_of([F.col(c).between(lo, hi) for c, (lo, hi) in ranges.items()]))


def all_nonneg_or_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.where(nonnegative_or_null(columns))


def within_limits(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Rows where every column is at most its limit; null passes."""
    return df.where(within_limits_or_null(limits))


def not_code(df: DataFrame, column: str, code) -> DataFrame:
    """Rows without the code; null passes."""
    return df.where(not_code_or_null(column, code))


def drop_null_targets(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Rows where every target is known; nothing is filled."""
    return df.where(all_of([F.col(c).isNotNull() for c in targets]))


def quantile_cap_filter(df: DataFrame, value: str, probability: float = 0.995) -> DataFrame:
    """Rows not above the exact quantile of the rows given (so filter first, then cap)."""
    (cap,) = quantile_values(df, value, [probability])
    return df.where(F.col(value) <= F.lit(cap))


def trim_quantile_band(
    df: DataFrame, value: str, low: float | None = 0.01, high: float | None = 0.99
) -> DataFrame:
    """Rows between two exact quantiles, both ends kept."""
    probs = [p for p in (low, high) if p is not None]
    bounds = quantile_values(df, value, probs)
    kept = df
    if low is not None:
        kept = kept.where(F.col(value) >= F.lit(bounds[0]))
    if high is not None:
        kept = kept.where(F.col(value) <= F.lit(bounds[-1]))
    return kept


def train_only_filter(df: DataFrame, split: str, condition: Column) -> DataFrame:
    """The condition removes training rows only; every test row stays."""
    keep = F.coalesce(condition, F.lit(False))
    return df.where((F.col(split) == "test") | keep)
