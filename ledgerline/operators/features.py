"""Feature projections: one ``select`` each, so every expression sees the input columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import expressions as x


def clip_with_flags(
    df: DataFrame, value: str, low: float, high: float, capped: str | None = None,
    zero: str | None = None, adjusted: str | None = None, keep_null: bool = False,
) -> DataFrame:
    """Clamp a column and add flags computed from the values before clamping."""
    c = F.col(value)
    new = {value: x.clip(value, low, high)}
    if capped:
        new[capped] = x.indicator(c > high, keep_null)
    if zero:
        new[zero] = x.indicator(c == 0, keep_null)
    if adjusted:
        new[adjusted] = x.indicator(x.outside(value, low, high), keep_null)
    return df.withColumns(new)


def fill_constants(df: DataFrame, constants: Mapping[str, object], flags: bool = False) -> DataFrame:
    """Per-column constants for null; ``flags`` keeps ``<col>_was_missing`` beside them."""
    new = {}
    types = dict(df.dtypes)
    for c, value in constants.items():
        new[c] = F.coalesce(F.col(c), F.lit(value).cast(types[c]))
        if flags:
            new[f"{c}_was_missing"] = F.col(c).isNull()
    return df.withColumns(new)


def missing_flags(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_was_missing": F.col(c).isNull() for c in columns})


def time_features(df: DataFrame, ts: str, prefix: str = "pickup") -> DataFrame:
    """hour, weekday (Monday 0) and weekend flag."""
    return df.withColumns({
        f"{prefix}_hour": x.hour_of(ts),
        f"{prefix}_weekday": x.weekday_of(ts),
        "is_weekend": x.weekend_flag(ts),
    })


def cyclic_features(df: DataFrame, ts: str, prefix: str = "pickup") -> DataFrame:
    """Sine/cosine of hour and weekday."""
    hour_sin, hour_cos = x.cyclic(x.hour_of(ts), 24)
    day_sin, day_cos = x.cyclic(x.weekday_of(ts), 7)
    return df.withColumns({
        f"{prefix}_hour_sin": hour_sin,
        f"{prefix}_hour_cos": hour_cos,
        f"{prefix}_dayofweek_sin": day_sin,
        f"{prefix}_dayofweek_cos": day_cos,
    })


def route_features(df: DataFrame, start: str, end: str, ts: str) -> DataFrame:
    """pickup_period, route_id and route_period_id."""
    period = x.day_period(x.hour_of(ts))
    route = x.composite_key(start, end)
    return df.withColumns({
        "pickup_period": period,
        "route_id": route,
        "route_period_id": x.composite_key(route, period),
    })


def one_hot_values(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Distinct values of each column, which become columns; one pass over all of them.

    Each value will be a column of the result, so it is the result's width that bounds them:
    a column with very many values belongs in ``one_hot_long``.
    """
    sets = df.agg(*[F.collect_set(c).alias(c) for c in columns], *[
        F.bool_or(F.col(c).isNull()).alias(f"_null_{c}") for c in columns
    ]).first()
    return {c: sorted(sets[c]) + [None] * bool(sets[f"_null_{c}"]) for c in columns}


def one_hot_columns(df: DataFrame, columns: Sequence[str], separator: str = "_") -> DataFrame:
    """Replace code columns by 0/1 columns, one per value present (null has its own)."""
    new: list[Column] = [F.col(c) for c in df.columns if c not in columns]
    for c, values in one_hot_values(df, list(columns)).items():
        for value in values:
            name = f"{c}{separator}{'null' if value is None else value}"
            new.append(F.col(c).eqNullSafe(F.lit(value)).cast("byte").alias(name))
    return df.select(*new)


def one_hot_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """ids, column, value: the ones of a one-hot table, for any number of values."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return df.selectExpr(*ids, f"stack({len(list(columns))}, {pairs}) AS (column, value)")


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def round_columns(df: DataFrame, digits: Mapping[str, int] | int) -> DataFrame:
    """Round doubles by scaling and rounding half to even; an int applies to all double columns."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    plan = {c: digits for c in doubles} if isinstance(digits, int) else dict(digits)
    return df.withColumns({c: F.rint(F.col(c) * 10.0**n) / 10.0**n for c, n in plan.items()})


def label_table_join(df: DataFrame, code: str, labels: DataFrame, label: str, default: str = "Other") -> DataFrame:
    """Left join to a (code, label) table with a fallback for unknown codes."""
    from ledgerline.functions.sizing import lookup_join, measured

    return lookup_join(df, measured(labels.select(code, label)), [code]).withColumn(
        label, F.coalesce(F.col(label), F.lit(default))
    )
