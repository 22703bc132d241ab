"""Exact quantiles with linear interpolation, without gathering a large group in one task.

A first pass counts each group and sketches it. Groups of a checked size go through the
built-in ``percentile``, which keeps one value-to-count map per group. Beyond that size
the sketch brackets each wanted rank, a second pass counts the values inside the brackets
and lumps the others together, and the rank is found in those counts. The sketch decides
how much is shuffled, never the result: a rank outside its bracket stops the job.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.expressions import nan_to_null
from ledgerline.functions.sizing import fits_broadcast, measured

SMALL_GROUP = 100_000  # values of a group that may share one buffer
SKETCH_K = 2048
BRACKET_MARGIN = 0.006  # more than four times the sketch's 99 % rank error at this k
SKETCH_FANOUT = 256
SLOTS_PER_BRACKET = 1024


def quantile_names(probabilities: Sequence[float]) -> list[str]:
    return [f"q{i}" for i in range(len(probabilities))]


def _brackets(base: DataFrame, keys: list[str], probabilities: Sequence[float]) -> DataFrame:
    """keys, n, and lo_i/hi_i around each probability, from a two-level sketch merge."""
    partial = (
        base.withColumn("_part", F.pmod(F.spark_partition_id(), F.lit(SKETCH_FANOUT)))
        .groupBy(*keys, "_part")
        .agg(
            F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("_sketch"),
            F.count("*").alias("_n"),
        )
    )
    merged = partial.groupBy(*keys).agg(
        F.kll_merge_agg_double("_sketch").alias("_sketch"), F.sum("_n").alias("_n")
    )
    edges = []
    for i, p in enumerate(probabilities):
        low, high = max(0.0, p - BRACKET_MARGIN), min(1.0, p + BRACKET_MARGIN)
        edges.append(F.kll_sketch_get_quantile_double("_sketch", F.lit(low)).alias(f"_lo{i}"))
        edges.append(F.kll_sketch_get_quantile_double("_sketch", F.lit(high)).alias(f"_hi{i}"))
    return merged.where(F.col("_n") > 0).select(*keys, "_n", *edges)


def _scale(value: Column) -> Column:
    """Keeps the order, and spreads a heavy tail: slots are equally wide on this scale."""
    return F.signum(value) * F.log1p(F.abs(value))


def _slot(count: int) -> tuple[Column, Column]:
    """Order-preserving slot number of ``_v`` and whether it lies inside a bracket."""
    width = SLOTS_PER_BRACKET
    inside = F.lit(False)
    slot = F.lit(0)
    # Later brackets first, so that the first bracket holding a value decides.
    for i in range(count):
        slot = F.when(F.col("_v") > F.col(f"_hi{i}"), F.lit(i * (width + 2) + width + 2)).otherwise(slot)
    for i in reversed(range(count)):
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        here = F.col("_v").between(low, high)
        bottom, top = _scale(low), _scale(high)
        step = F.when(
            top > bottom,
            F.least(F.floor((_scale(F.col("_v")) - bottom) / (top - bottom) * width), F.lit(width - 1)),
        ).otherwise(F.lit(0))
        slot = F.when(here, F.lit(i * (width + 2) + 1) + step).otherwise(slot)
        inside = inside | here
    return slot, inside


def quantile_table(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    keys: Sequence[str] = (),
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """keys, ``n`` (non-null values) and ``q0..`` as linearly interpolated quantiles.

    Probabilities must ascend. Groups without any value are left out.
    """
    probs = list(probabilities)
    if probs != sorted(probs):
        raise ValueError("probabilities must ascend")
    keys = list(keys)
    base = df.select(*keys, nan_to_null(value).alias("_v")).where(F.col("_v").isNotNull())
    bounds = _brackets(base, keys, probs).persist(StorageLevel.MEMORY_AND_DISK)
    largest = bounds.agg(F.max("_n")).first()[0] or 0  # fills the cache, so its size is known
    if largest <= small_group:
        bounds.unpersist()
        return _buffered(base, keys, probs)
    if not keys or fits_broadcast(bounds):
        return _ranked(base, bounds, keys, probs)
    # Many groups, some of them large: only those are ranked.
    large = measured(bounds.where(F.col("_n") > small_group))
    return _ranked(base, large, keys, probs).unionByName(_buffered(_without(base, large, keys), keys, probs))


def _same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null is a group of its own, as in groupBy."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def _without(base: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    return base.alias("_l").join(groups.alias("_r"), _same_keys("_l", "_r", keys), "left_anti")


def _buffered(base: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """One buffer per group; for groups of a checked size."""
    wanted = F.array(*[F.lit(float(p)) for p in probs])
    found = base.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile("_v", wanted).alias("_q"))
    return found.where(F.col("n") > 0).select(
        *keys, "n", *[F.col("_q")[i].alias(q) for i, q in enumerate(quantile_names(probs))]
    )


def _ranked(base: DataFrame, bounds: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Ranks found in counts of bracketed values; for groups of any size."""
    if keys:
        tagged = base.alias("_l").join(bounds.alias("_r"), _same_keys("_l", "_r", keys)).select(
            *[F.col(f"_l.{k}") for k in keys], "_v", *[c for c in bounds.columns if c not in keys]
        )
    else:
        row = bounds.first()
        bounds.unpersist()
        tagged = base.withColumns({name: F.lit(row[name]) for name in bounds.columns})

    slot, inside = _slot(len(probs))
    counts = (
        tagged.select(*keys, "_n", slot.alias("_slot"), F.when(inside, F.col("_v")).alias("_at"))
        .groupBy(*keys, "_n", "_slot", "_at")
        .agg(F.count("*").alias("_c"))
    )

    # At most a few thousand slots per key.
    by_slot = Window.partitionBy(*keys).orderBy("_slot") if keys else Window.orderBy("_slot")
    ranks = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        ranks += [F.floor(position).alias(f"_f{i}"), F.ceil(position).alias(f"_t{i}")]
    rank_names = [f"_{side}{i}" for i in range(len(probs)) for side in ("f", "t")]
    slots = (
        counts.groupBy(*keys, "_n", "_slot")
        .agg(F.sum("_c").alias("_s"))
        .withColumn("_before", F.sum("_s").over(by_slot) - F.col("_s"))
        .select(*keys, "_slot", "_s", "_before", *ranks)
    )
    holds = reduce(
        or_,
        [(F.col("_before") <= F.col(r)) & (F.col(r) < F.col("_before") + F.col("_s")) for r in rank_names],
    )
    wanted = slots.where(holds).drop("_s")

    near = counts.alias("_c").join(wanted.alias("_w"), _same_keys("_c", "_w", [*keys, "_slot"])).select(
        *[F.col(f"_c.{k}") for k in keys],
        F.col("_c._n").alias("_n"), F.col("_c._slot").alias("_slot"),
        F.col("_c._at").alias("_at"), F.col("_c._c").alias("_c"), "_before", *rank_names,
    )
    inside_slot = Window.partitionBy(*keys, "_slot").orderBy("_at")
    ranked = near.withColumn("_upto", F.col("_before") + F.sum("_c").over(inside_slot))
    start = F.col("_upto") - F.col("_c")

    picks = []
    for name in rank_names:
        hit = (start <= F.col(name)) & (F.col(name) < F.col("_upto"))
        found = F.when(hit, F.coalesce(
            F.col("_at"), F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
        ))
        picks.append(F.max(found).alias(name + "v"))
    result = ranked.groupBy(*keys, "_n").agg(*picks)
    values = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("_n") - 1)
        low, high = F.col(f"_f{i}v"), F.col(f"_t{i}v")
        values.append((low + (high - low) * (position - F.floor(position))).alias(f"q{i}"))
    return result.select(*keys, F.col("_n").alias("n"), *values)


def quantile_values(df: DataFrame, value: str, probabilities: Sequence[float]) -> list[float | None]:
    """The quantiles of one column as numbers; nulls for an empty column."""
    row = quantile_table(df, value, probabilities).first()
    return [None] * len(list(probabilities)) if row is None else [row[q] for q in quantile_names(probabilities)]


def median_value(df: DataFrame, value: str) -> float | None:
    return quantile_values(df, value, [0.5])[0]


def column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """column, n, q0.. for several numeric columns in the same passes."""
    return quantile_table(unpivot_values(df, columns), "value", probabilities, ["column"])


def unpivot_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows of numeric columns, generated inside the scan stage."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    return df.selectExpr(f"stack({len(list(columns))}, {pairs}) AS (column, value)")
