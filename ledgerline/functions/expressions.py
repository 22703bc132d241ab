"""Row-local column expressions. All stay inside whole-stage codegen."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names with Monday first.
WEEKDAY_LABELS = {0: "Mon", 1: "Tue", 2: "Wed", 3: "Thu", 4: "Fri", 5: "Sat", 6: "Sun"}

# Right-closed hour edges and their names.
DAY_PERIOD_EDGES = (5, 9, 15, 19, 23)
DAY_PERIOD_LABELS = ("night", "morning_peak", "daytime", "evening_peak", "late_evening")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_of(conditions: Sequence[Column]) -> Column:
    """OR over generated conditions."""
    return reduce(or_, conditions)


def all_of(conditions: Sequence[Column]) -> Column:
    """AND over generated conditions."""
    return reduce(and_, conditions)


def nan_to_null(value: Column | str) -> Column:
    """Null instead of NaN, because Spark orders NaN above every number."""
    return F.nanvl(_col(value).cast("double"), F.lit(None).cast("double"))


def is_finite(value: Column | str) -> Column:
    """True for a value that is neither null, NaN nor infinite."""
    c = _col(value).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def indicator(condition: Column, keep_null: bool = False) -> Column:
    """0/1 byte; an unknown condition is 0 unless ``keep_null``."""
    flag = condition if keep_null else F.coalesce(condition, F.lit(False))
    return flag.cast("byte")


def flag_equals(value: Column | str, expected) -> Column:
    """1 where the value equals ``expected``, 0 for other values and null."""
    return indicator(_col(value) == F.lit(expected))


def duration(start: Column | str, end: Column | str, unit_seconds: float = 60.0) -> Column:
    """Elapsed time in units of ``unit_seconds``; fractions are kept."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros / F.lit(unit_seconds * 1_000_000.0)


def hour_of(ts: Column | str) -> Column:
    return F.hour(_col(ts))


def weekday_of(ts: Column | str) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(_col(ts))


def weekend_flag(ts: Column | str) -> Column:
    return indicator(weekday_of(ts) >= 5)


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clamp to [low, high]; null stays null (``least``/``greatest`` alone skip nulls)."""
    c = _col(value)
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low).cast("double"))
    if high is not None:
        bounded = F.least(bounded, F.lit(high).cast("double"))
    return F.when(c.isNotNull(), bounded)


def outside(value: Column | str, low: float, high: float) -> Column:
    """True where the value lies below ``low`` or above ``high``."""
    c = _col(value)
    return (c < low) | (c > high)


def invalid_to_null(value: Column | str, low: float, high: float) -> Column:
    """Null where a value is out of [low, high]."""
    c = _col(value)
    return F.when(c.between(low, high), c)


def cyclic(value: Column | str, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a periodic value."""
    angle = F.lit(2.0 * math.pi) * _col(value) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def day_period(hour: Column | str) -> Column:
    """Name of the right-closed hour range; null outside 0..23."""
    c = _col(hour)
    chain = F.when(c < 0, F.lit(None).cast("string"))
    for edge, label in zip(DAY_PERIOD_EDGES, DAY_PERIOD_LABELS, strict=True):
        chain = chain.when(c <= edge, F.lit(label))
    return chain


def value_band(value: Column | str, edges: Sequence[float], labels: Sequence[str],
               floor: float | None = None) -> Column:
    """Left-closed bands: ``labels[i]`` for edges[i-1] <= value < edges[i].

    Values below ``floor`` get no band.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    c = nan_to_null(value)
    chain = F.when(c.isNull(), F.lit(None).cast("string"))
    if floor is not None:
        chain = chain.when(c < floor, F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        chain = chain.when(c < edge, F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))


def composite_key(*parts: Column | str, separator: str = "_") -> Column:
    """Joined text key; null when any part is null."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(separator))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Division that gives null for a zero denominator."""
    return _col(numerator) / F.nullif(_col(denominator), F.lit(0.0))


def threshold_label(value: Column | str, threshold: float) -> Column:
    return indicator(_col(value) >= threshold)


def membership_flag(columns: Sequence[Column | str], codes: Sequence) -> Column:
    """1 if any of the columns holds one of the codes."""
    return indicator(any_of([F.coalesce(_col(c).isin(*codes), F.lit(False)) for c in columns]))


def row_sum(columns: Sequence[Column | str], nulls: str = "zero") -> Column:
    """Sum across columns.

    ``zero``: null counts as 0. ``any``: null only when all are null.
    ``all``: null when any is null.
    """
    cols = [_col(c) for c in columns]
    if nulls == "all":
        return reduce(add, cols)
    total = reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cols])
    if nulls == "zero":
        return total
    if nulls == "any":
        return F.when(any_of([c.isNotNull() for c in cols]), total)
    raise ValueError(f"unknown null mode: {nulls}")


def label_lookup(code: Column | str, labels: Mapping, default: str = "Other") -> Column:
    """Label of a code from a small fixed map, with a fallback."""
    c = _col(code)
    chain = F.when(F.lit(False), F.lit(default))
    for key, label in labels.items():
        chain = chain.when(c == F.lit(key), F.lit(label))
    return chain.otherwise(F.lit(default))


def coerce_timestamp(text: Column | str) -> Column:
    """Timestamp without zone, or null for unreadable text."""
    return _col(text).try_cast("timestamp_ntz")


def coerce_number(text: Column | str) -> Column:
    """Double, or null for unreadable text."""
    return _col(text).try_cast("double")


def log_target(value: Column | str) -> Column:
    return F.log1p(_col(value))


def unlog_target(value: Column | str) -> Column:
    return F.expm1(_col(value))


def combine_two_stage(has_amount: Column | str, amount: Column | str) -> Column:
    """Non-negative amount where the first stage says there is one, else 0."""
    return F.when(_col(has_amount).cast("boolean"), F.greatest(_col(amount), F.lit(0.0))).otherwise(0.0)


def nonnegative_or_null(columns: Sequence[Column | str]) -> Column:
    """Every column is >= 0 or null."""
    return all_of([(_col(c) >= 0) | _col(c).isNull() for c in columns])


def within_limits_or_null(limits: Mapping[str, float]) -> Column:
    """Every column is at most its own limit, or null."""
    return all_of([(F.col(c) <= limit) | F.col(c).isNull() for c, limit in limits.items()])


def not_code_or_null(column: Column | str, code) -> Column:
    return F.coalesce(_col(column) != F.lit(code), F.lit(True))
