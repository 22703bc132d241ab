"""Describe and correlation tables, rank correlation and the two-group Welch test."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.distributions import t_two_sided_p
from ledgerline.functions.prefix import running_total
from ledgerline.functions.quantiles import column_quantiles, quantile_values, unpivot_values
from ledgerline.functions.sizing import lookup_join, measured


def describe_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, count, mean, std, min, q25, q50, q75, max. Exact quartiles, sample deviation."""
    moments = unpivot_values(df, columns).groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """col_a, col_b, r for all ordered pairs; each pair uses the rows where both are known."""
    names = list(columns)
    whole = co_moments(df, names)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, raw in zip(batch["place"], batch["moments"]):
                n, _, _, xx, yy, xy = np.frombuffer(raw, np.float64).reshape(6, -1)
                scale = np.sqrt(xx) * np.sqrt(yy)
                r = [float(c / s) if s > 0 and k > 1 else None for c, s, k in zip(xy, scale, n)]
                r[a] = 1.0 if xx[a] > 0 else None  # a constant column has no correlation with itself
                yield pd.DataFrame({"col_a": names[a], "col_b": names, "r": pd.array(r, "Float64")})

    return whole.mapInPandas(rows, "col_a string, col_b string, r double")


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(place, moments): per column its pairwise counts, means and sums of squared deviations with
    every column, as six rows of doubles, over the rows where both are known.

    A task multiplies blocks of values and of known marks, about the block's means, and keeps
    one table; the tables of a column merge by the rule for two groups' moments.
    """
    width = len(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    schema = "place int, moments binary"

    def block(x: np.ndarray) -> np.ndarray:
        known = ~np.isnan(x)
        marks = known.astype(np.float64)
        seen = marks.sum(axis=0)
        shift = np.divide(np.where(known, x, 0).sum(axis=0), seen, out=np.zeros(width), where=seen > 0)
        z = np.where(known, x - shift, 0.0)
        n = marks.T @ marks
        safe = np.maximum(n, 1)
        sx, sy = z.T @ marks, marks.T @ z
        xx, yy = (z * z).T @ marks - sx * sx / safe, marks.T @ (z * z) - sy * sy / safe
        return np.stack([n, sx / safe + shift[:, None], sy / safe + shift[None, :], np.maximum(xx, 0), np.maximum(yy, 0), z.T @ z - sx * sy / safe])

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            own = block(batch.to_numpy(np.float64))
            total = own if total is None else merged_moments(total, own)
        if total is not None:
            yield pd.DataFrame({"place": range(width), "moments": [total[:, i].tobytes() for i in range(width)]})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        total = None
        for raw in part["moments"]:
            own = np.frombuffer(raw, np.float64).reshape(6, width)
            total = own if total is None else merged_moments(total, own)
        return pd.DataFrame({"place": [part["place"].iloc[0]], "moments": [total.tobytes()]})

    return numbers.mapInPandas(task, schema).groupBy("place").applyInPandas(merge, schema)


def merged_moments(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Counts, means and co-moments of two groups together, for each pair of columns."""
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    dx, dy, share = b[1] - a[1], b[2] - a[2], a[0] * b[0] / safe
    return np.stack([n, a[1] + dx * b[0] / safe, a[2] + dy * b[0] / safe, a[3] + b[3] + dx * dx * share, a[4] + b[4] + dy * dy * share, a[5] + b[5] + dx * dy * share])


def target_correlations(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """column, r with the target, highest first."""
    row = df.agg(*[F.corr(c, target).alias(f"_r{i}") for i, c in enumerate(columns)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"_r{i}").alias("r")) for i, c in enumerate(columns)
    ]
    return row.select(F.inline(F.array(*entries))).orderBy(F.desc("r"), "column")


def correlation_pair(df: DataFrame, a: str, b: str, clipped: Column | None = None) -> DataFrame:
    """Pearson r of one pair on complete rows, beside r with ``a`` clipped."""
    aggregates = [
        F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("row_count"),
        F.corr(a, b).alias("r"),
    ]
    if clipped is not None:
        aggregates.append(F.corr(clipped, F.col(b)).alias("r_clipped"))
    return df.agg(*aggregates)


def average_rank(df: DataFrame, value: str, rank: str = "rank") -> DataFrame:
    """value, copies, rank for each distinct value; ties share the mean of their ranks.

    Copies are counted first, so a hot value is one row; ranks are running totals over the
    distinct values, block by block.
    """
    copies = (
        df.select(F.col(value).cast("double").alias(value))
        .where(F.col(value).isNotNull())
        .groupBy(value)
        .agg(F.count("*").alias("copies"))
    )
    return running_total(copies, [value], "copies", "_upto").select(
        value, "copies", (F.col("_upto") - (F.col("copies") - 1) / 2.0).alias(rank)
    )


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation on rows where both are known: Pearson on average ranks, by pair counts."""
    pairs = (
        df.select(F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b"))
        .where(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    )
    counted = pairs.groupBy("_a", "_b").agg(F.count("*").alias("_n"))
    rank_a = measured(average_rank(pairs, "_a", "_ra").drop("copies"))
    rank_b = measured(average_rank(pairs, "_b", "_rb").drop("copies"))
    ranked = lookup_join(lookup_join(counted, rank_a, ["_a"]), rank_b, ["_b"])
    mean = (pairs.count() + 1) / 2.0
    da, db, n = F.col("_ra") - mean, F.col("_rb") - mean, F.col("_n")
    sums = ranked.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("row_count"),
        F.sum(n * da * db).alias("_ab"),
        F.sum(n * da * da).alias("_aa"),
        F.sum(n * db * db).alias("_bb"),
    )
    scale = F.sqrt(F.col("_aa")) * F.sqrt(F.col("_bb"))
    return sums.select("row_count", (F.col("_ab") / F.nullif(scale, F.lit(0.0))).alias("rho"))


def welch_ttest(
    df: DataFrame, value: str, group_a: Column, group_b: Column,
    name_a: str, name_b: str, alpha: float = 0.05, p_value: bool = True,
) -> DataFrame:
    """Group sizes and means, t, degrees of freedom, Cohen's d, and two-sided p with its flag.

    The data is aggregated on Spark; p comes from the few resulting scalars.
    """
    side = F.when(group_a, F.lit("a")).when(group_b, F.lit("b"))
    moments = df.select(side.alias("_side"), F.col(value).alias("_x")).where(
        F.col("_side").isNotNull() & F.col("_x").isNotNull()
    ).agg(*[
        f(F.when(F.col("_side") == s, F.col("_x"))).alias(f"_{n}{s}")
        for s in ("a", "b")
        for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))
    ])
    na, nb, ma, mb, va, vb = [F.col(c) for c in ("_na", "_nb", "_ma", "_mb", "_va", "_vb")]
    sa, sb = va / F.nullif(na, F.lit(0)), vb / F.nullif(nb, F.lit(0))
    degrees = (sa + sb) * (sa + sb) / F.nullif(sa * sa / (na - 1) + sb * sb / (nb - 1), F.lit(0.0))
    pooled = F.sqrt(((na - 1) * va + (nb - 1) * vb) / F.nullif(na + nb - 2, F.lit(0)))
    result = moments.select(
        F.lit(name_a).alias("group_1"), F.lit(name_b).alias("group_2"),
        na.alias("group_1_rows"), nb.alias("group_2_rows"),
        ma.alias("group_1_mean"), mb.alias("group_2_mean"),
        ((ma - mb) / F.nullif(F.sqrt(sa + sb), F.lit(0.0))).alias("t_statistic"),
        degrees.alias("degrees_of_freedom"),
        ((ma - mb) / F.nullif(pooled, F.lit(0.0))).alias("cohens_d"),
    )
    if not p_value:
        return result
    row = result.first()
    if row["group_1_rows"] == 0 or row["group_2_rows"] == 0:
        raise ValueError("a group of the test is empty")
    p = None
    if row["t_statistic"] is not None and row["degrees_of_freedom"] is not None:
        p = t_two_sided_p(row["t_statistic"], row["degrees_of_freedom"])
    return df.sparkSession.createDataFrame(
        [(*row, p, None if p is None else p < alpha)],
        result.schema.add("p_value", "double").add("significant", "boolean"),
    )


def residual_summary(
    df: DataFrame, actual: str, predicted: str, low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Residual mean, its two quantile bounds, and rows between them."""
    residuals = df.select((F.col(predicted) - F.col(actual)).alias("residual"))
    lower, upper = quantile_values(residuals, "residual", [low, high])
    inside = F.col("residual").between(F.lit(lower), F.lit(upper))
    return residuals.agg(
        F.count("residual").alias("row_count"),
        F.avg("residual").alias("mean_residual"),
        F.lit(lower).alias("lower_bound"),
        F.lit(upper).alias("upper_bound"),
        F.count_if(inside).alias("rows_inside"),
        F.avg(inside.cast("int")).alias("share_inside"),
    )
