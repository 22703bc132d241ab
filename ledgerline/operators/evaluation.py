"""Regression, band and classification metrics as aggregates over predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.prefix import running_total

from ledgerline.functions.expressions import is_finite, row_sum, value_band
from ledgerline.functions.quantiles import median_value, quantile_table

# The bands of the actual amount.
AMOUNT_BAND_EDGES = (30.0, 60.0, 100.0)
AMOUNT_BAND_LABELS = ("under_30", "30_to_60", "60_to_100", "100_plus")

METRICS = ("mae", "rmse", "median_ae", "r2")


def _error_aggregates(actual: str, predicted: str) -> list[Column]:
    error = F.col(predicted) - F.col(actual)
    r2 = 1.0 - F.avg(error * error) / F.nullif(F.var_pop(actual), F.lit(0.0))
    return [
        F.count("*").alias("row_count"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r2.alias("r2"),
    ]


def metric_guards(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Counts of what makes a table unfit for scoring."""
    return df.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col(actual).isNull()).alias("actual_nulls"),
        F.count_if(F.col(predicted).isNull()).alias("predicted_nulls"),
        F.count_if(F.col(actual).isNotNull() & ~is_finite(actual)).alias("actual_not_finite"),
        F.count_if(F.col(predicted).isNotNull() & ~is_finite(predicted)).alias("predicted_not_finite"),
    )


def require_scorable(df: DataFrame, actual: str, predicted: str) -> None:
    """Raise unless there are two rows or more and every value is finite."""
    row = metric_guards(df, actual, predicted).first()
    if row["row_count"] < 2:
        raise ValueError("R2 needs at least two rows")
    if any(row[c] for c in row.asDict() if c != "row_count"):
        raise ValueError("actual or predicted values are missing or not finite")


def regression_metrics(df: DataFrame, actual: str, predicted: str, keys: Sequence[str] = ()) -> DataFrame:
    """keys, row_count, mae, rmse, median_ae, r2. R2 is null where the actual value is constant."""
    keys = list(keys)
    scored = df.select(*keys, F.col(actual).alias("_actual"), F.col(predicted).alias("_predicted"))
    errors = scored.withColumn("_ae", F.abs(F.col("_predicted") - F.col("_actual")))
    sums = scored.groupBy(*keys).agg(*_error_aggregates("_actual", "_predicted"))
    if not keys:
        return sums.select(
            "row_count", "mae", "rmse", F.lit(median_value(errors, "_ae")).alias("median_ae"), "r2"
        )
    medians = quantile_table(errors, "_ae", [0.5], keys)
    return sums.alias("s").join(medians.alias("m"), _same(keys), "left").select(
        *[F.col(f"s.{k}").alias(k) for k in keys], "s.row_count", "s.mae", "s.rmse",
        F.col("m.q0").alias("median_ae"), "s.r2",
    )


def _same(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(f"s.{k}").eqNullSafe(F.col(f"m.{k}"))
    return condition


def band_metrics(
    df: DataFrame, actual: str, predicted: str,
    edges: Sequence[float] = AMOUNT_BAND_EDGES, labels: Sequence[str] = AMOUNT_BAND_LABELS,
    band: str = "band",
) -> DataFrame:
    """Metrics per band of the actual value; empty bands are left out."""
    banded = df.withColumn(band, value_band(actual, edges, labels))
    return regression_metrics(banded, actual, predicted, [band])


def band_bias(
    df: DataFrame, actual: str, predicted: str,
    edges: Sequence[float] = AMOUNT_BAND_EDGES, labels: Sequence[str] = AMOUNT_BAND_LABELS,
    floor: float | None = 0.0, band: str = "band",
) -> DataFrame:
    """Rows, mean actual, mae, rmse and mean signed error per band."""
    error = F.col(predicted) - F.col(actual)
    return (
        df.withColumn(band, value_band(actual, edges, labels, floor))
        .where(F.col(band).isNotNull())
        .groupBy(band)
        .agg(
            F.count("*").alias("row_count"),
            F.avg(actual).alias("actual_mean"),
            F.avg(F.abs(error)).alias("mae"),
            F.sqrt(F.avg(error * error)).alias("rmse"),
            F.avg(error).alias("mean_error"),
        )
    )


def baseline_reduction(df: DataFrame, actual: str, predicted: str, baseline: str) -> DataFrame:
    """MAE of a prediction and of a baseline, and the reduction in percent."""
    mae = F.avg(F.abs(F.col(predicted) - F.col(actual)))
    base = F.avg(F.abs(F.col(baseline) - F.col(actual)))
    return df.agg(mae.alias("mae"), base.alias("baseline_mae")).withColumn(
        "reduction_percent",
        (F.col("baseline_mae") - F.col("mae")) / F.nullif(F.col("baseline_mae"), F.lit(0.0)) * 100.0,
    )


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def classification_metrics(
    df: DataFrame, actual: str, predicted: str, positive=1, baseline: object = None
) -> DataFrame:
    """row_count, accuracy, weighted_f1, binary_f1 (0 for no hits) and baseline accuracy.

    Everything follows from the confusion counts, one row per pair of classes.
    """
    counts = confusion_counts(df, actual, predicted)
    hits = F.col("actual").eqNullSafe(F.col("predicted"))
    cells = counts.select(
        F.inline(F.array(
            F.struct(F.col("actual").alias("cls"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"),
                     F.when(hits, F.col("n")).otherwise(0).alias("hit")),
            F.struct(F.col("predicted").alias("cls"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"),
                     F.lit(0).cast("long").alias("hit")),
        ))
    )
    classes = cells.groupBy("cls").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit")
    ).withColumn("f1", 2.0 * F.col("hit") / (F.col("support") + F.col("called")))
    total = F.sum("support")
    aggregates = [
        total.alias("row_count"),
        (F.sum("hit") / total).alias("accuracy"),
        (F.sum(F.col("f1") * F.col("support")) / total).alias("weighted_f1"),
        F.coalesce(F.max(F.when(F.col("cls") == F.lit(positive), F.col("f1"))), F.lit(0.0)).alias("binary_f1"),
    ]
    if baseline is not None:
        known = F.sum(F.when(F.col("cls") == F.lit(baseline), F.col("support")).otherwise(0))
        aggregates.append((known / total).alias("baseline_accuracy"))
    return classes.agg(*aggregates)


def multi_target_eval(
    df: DataFrame, targets: Mapping[str, str], total: str | None = None
) -> DataFrame:
    """target, row_count, mae, rmse, r2 per (actual -> prediction) pair, plus ``total``.

    Rows without an actual value are left out of that target. The total is compared with
    the row sum of all predictions.
    """
    pairs = dict(targets)
    frame = df
    if total is not None:
        frame = df.withColumn("_predicted_total", row_sum(list(targets.values())))
        pairs[total] = "_predicted_total"
    stacked = ", ".join(
        f"'{a}', CAST(`{a}` AS DOUBLE), CAST(`{p}` AS DOUBLE)" for a, p in pairs.items()
    )
    long = frame.selectExpr(f"stack({len(pairs)}, {stacked}) AS (target, actual, predicted)").where(
        F.col("actual").isNotNull()
    )
    return long.groupBy("target").agg(*_error_aggregates("actual", "predicted"))


def part_sum_mae(df: DataFrame, parts: Sequence[str], total: str) -> DataFrame:
    """Mean |total - sum of true parts| on rows where all are known."""
    gap = F.abs(F.col(total) - row_sum(parts, nulls="all"))
    return df.agg(F.count(gap).alias("row_count"), F.avg(gap).alias("component_sum_mae"))


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: positives, negatives, and how many of each score the same or less."""
    counts = df.where(F.col(label).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives")
    )
    for amount in ("positives", "negatives"):
        counts = running_total(counts, ["score"], amount, f"{amount}_upto")
    return counts


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """row_count, positives, negatives and the exact area: the share of pairs of a positive and a
    negative that the score orders rightly, ties half. Null without both classes.

    Counts per distinct score and running totals over them; no bins.
    """
    below = F.col("negatives_upto") - F.col("negatives")
    right = F.sum(F.col("positives").cast("decimal(19,0)") * (2 * below + F.col("negatives")).cast("decimal(19,0)")).cast("double") / 2
    totals = score_counts(df, label, score).agg(
        F.coalesce(F.sum("positives"), F.lit(0)).alias("positives"), F.coalesce(F.sum("negatives"), F.lit(0)).alias("negatives"), right.alias("right")
    )
    pairs = F.col("positives").cast("double") * F.col("negatives")
    return totals.select(
        (F.col("positives") + F.col("negatives")).alias("row_count"), "positives", "negatives",
        (F.col("right") / F.nullif(pairs, F.lit(0.0))).alias("roc_auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """score, true_positive_rate, false_positive_rate when rows with that score or more are called positive."""
    counts = score_counts(df, label, score)
    totals = counts.agg(F.sum("positives").alias("p"), F.sum("negatives").alias("n"))
    above = {k: F.col(t) - F.col(f"{k}_upto") + F.col(k) for k, t in (("positives", "p"), ("negatives", "n"))}
    return counts.join(F.broadcast(totals)).select(
        "score", (above["positives"] / F.nullif("p", F.lit(0))).alias("true_positive_rate"),
        (above["negatives"] / F.nullif("n", F.lit(0))).alias("false_positive_rate"),
    )
