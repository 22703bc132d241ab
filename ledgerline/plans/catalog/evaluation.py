"""Metrics of the group-mean predictor, result records and the leaderboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import evaluation as ev
from ledgerline.operators import joins
from ledgerline.operators import models
from ledgerline.operators import results as res
from ledgerline.operators.splits import random_split_hash
from ledgerline.operators.statistics import residual_summary as residuals
from ledgerline.plans.bindings import (
    EVENTS_SPLIT_SQL,
    TRIP_HASH_SQL,
    TRIP_IDS,
    TRIP_SQL,
    events_split,
    trip,
)
from ledgerline.plans.registry import query
from ledgerline.session import scratch_path
from ledgerline.sources.sinks import save_results

# The predictor: the user's training mean of the value, else the overall one.
PREDICTED_SQL = EVENTS_SPLIT_SQL + """, train AS (SELECT * FROM events_split WHERE split = 'train'),
predicted AS (
  SELECT e.event_id, e.event_type, e.user_id, e.value, coalesce(m, (SELECT avg(value) FROM train)) AS prediction,
         (SELECT avg(value) FROM train) AS baseline
  FROM events_split e LEFT JOIN (SELECT user_id, avg(value) AS m FROM train GROUP BY 1) s ON e.user_id = s.user_id
  WHERE split = 'test')"""

METRICS_SQL = """count(*) AS row_count, avg(abs(prediction - value)) AS mae,
  sqrt(avg((prediction - value) * (prediction - value))) AS rmse,
  quantile_cont(abs(prediction - value), 0.5) AS median_ae,
  1 - avg((prediction - value) * (prediction - value)) / nullif(var_pop(value), 0) AS r2"""

_BAND = "CASE WHEN value < 30 THEN 'under_30' WHEN value < 60 THEN '30_to_60' WHEN value < 100 THEN '60_to_100' ELSE '100_plus' END"


def predicted(spark, folder):
    rows = events_split(spark, folder)
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    scored = joins.apply_group_stats(train, test, "user_id", {"prediction": "value"})
    return models.baseline_constant(train, scored, "value", "mean", "baseline")


@query("baseline_constant", f"""
WITH {EVENTS_SPLIT_SQL}, train AS (SELECT * FROM events_split WHERE split = 'train')
SELECT event_id, (SELECT avg(value) FROM train) AS mean_prediction,
       (SELECT quantile_cont(value, 0.5) FROM train) AS median_prediction,
       (SELECT user_id FROM train GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)::DOUBLE AS mode_prediction
FROM events_split WHERE split = 'test'
""", rounded="mean_prediction median_prediction")
def baseline_constant(spark, folder):
    rows = events_split(spark, folder)
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    out = models.baseline_constant(train, test.select("event_id"), "value", "mean", "mean_prediction")
    out = models.baseline_constant(train, out, "value", "median", "median_prediction")
    return models.baseline_constant(train, out, "user_id", "mode", "mode_prediction")


@query("regression_metrics", f"WITH {PREDICTED_SQL} SELECT {METRICS_SQL} FROM predicted", rounded="mae rmse median_ae r2")
def regression_metrics(spark, folder):
    return ev.regression_metrics(predicted(spark, folder), "value", "prediction")


@query("metrics_by_group", f"""
WITH {PREDICTED_SQL} SELECT event_type, {METRICS_SQL} FROM predicted GROUP BY 1
""", rounded="mae rmse median_ae r2")
def metrics_by_group(spark, folder):
    return ev.regression_metrics(predicted(spark, folder), "value", "prediction", ["event_type"])


@query("metric_guards", f"""
WITH {PREDICTED_SQL},
marked AS (SELECT CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
                  CASE WHEN event_id % 11 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 13 = 0 THEN NULL ELSE prediction END AS prediction
           FROM predicted)
SELECT count(*) AS row_count, count(*) FILTER (WHERE value IS NULL) AS actual_nulls,
       count(*) FILTER (WHERE prediction IS NULL) AS predicted_nulls, 0::BIGINT AS actual_not_finite,
       count(*) FILTER (WHERE isnan(prediction)) AS predicted_not_finite FROM marked
""")
def metric_guards(spark, folder):
    marked = predicted(spark, folder).withColumns({
        "value": F.when(F.col("event_id") % 7 != 0, F.col("value")),
        "prediction": F.when(F.col("event_id") % 11 == 0, F.lit(float("nan")))
        .when(F.col("event_id") % 13 != 0, F.col("prediction")),
    })
    return ev.metric_guards(marked, "value", "prediction")


@query("band_metrics", f"WITH {PREDICTED_SQL} SELECT {_BAND} AS band, {METRICS_SQL} FROM predicted GROUP BY 1",
       rounded="mae rmse median_ae r2")
def band_metrics(spark, folder):
    return ev.band_metrics(predicted(spark, folder), "value", "prediction")


@query("band_bias", f"""
WITH {PREDICTED_SQL}
SELECT {_BAND} AS band, count(*) AS row_count, avg(value) AS actual_mean, avg(abs(prediction - value)) AS mae,
       sqrt(avg((prediction - value) * (prediction - value))) AS rmse, avg(prediction - value) AS mean_error
FROM predicted GROUP BY 1
""", rounded="actual_mean mae rmse mean_error")
def band_bias(spark, folder):
    return ev.band_bias(predicted(spark, folder), "value", "prediction")


@query("baseline_reduction", f"""
WITH {PREDICTED_SQL}
SELECT mae, baseline_mae, (baseline_mae - mae) / baseline_mae * 100 AS reduction_percent FROM (
  SELECT avg(abs(prediction - value)) AS mae, avg(abs(baseline - value)) AS baseline_mae FROM predicted) t
""", rounded="mae baseline_mae reduction_percent")
def baseline_reduction(spark, folder):
    return ev.baseline_reduction(predicted(spark, folder), "value", "prediction", "baseline")


@query("classification_metrics", f"""
WITH {PREDICTED_SQL},
marked AS (SELECT CASE WHEN value >= 60 THEN 1 ELSE 0 END AS a, CASE WHEN prediction >= 50 THEN 1 ELSE 0 END AS p FROM predicted),
classes AS (
  SELECT c, count(*) FILTER (WHERE a = c) AS support, count(*) FILTER (WHERE p = c) AS called,
         count(*) FILTER (WHERE a = c AND p = c) AS hit
  FROM marked, (VALUES (0), (1)) v(c) GROUP BY c),
scored AS (SELECT *, 2.0::DOUBLE * hit / (support + called) AS f1 FROM classes)
SELECT CAST(sum(support) AS BIGINT) AS row_count, CAST(sum(hit) AS DOUBLE) / sum(support) AS accuracy,
       sum(f1 * support) / sum(support) AS weighted_f1, max(f1) FILTER (WHERE c = 1) AS binary_f1,
       CAST(sum(support) FILTER (WHERE c = 0) AS DOUBLE) / sum(support) AS baseline_accuracy FROM scored
""", rounded="accuracy weighted_f1 binary_f1 baseline_accuracy")
def classification_metrics(spark, folder):
    marked = predicted(spark, folder).select(
        (F.col("value") >= 60).cast("int").alias("a"), (F.col("prediction") >= 50).cast("int").alias("p")
    )
    return ev.classification_metrics(marked, "a", "p", positive=1, baseline=0)


_TRIP_PREDICTED_SQL = TRIP_SQL + f""", trip_split AS (
  SELECT *, CASE WHEN {TRIP_HASH_SQL} % 10 < 2 THEN 'test' ELSE 'train' END AS split FROM trip),
trip_train AS (SELECT * FROM trip_split WHERE split = 'train'),
trip_predicted AS (
  SELECT t.*, pn, pt FROM trip_split t
  LEFT JOIN (SELECT l_partkey, avg(net) AS pn, avg(tax) AS pt FROM trip_train GROUP BY 1) s ON t.l_partkey = s.l_partkey
  WHERE split = 'test'),
trip_filled AS (
  SELECT net, tax, amount, coalesce(pn, (SELECT avg(net) FROM trip_train)) AS net_prediction,
         coalesce(pt, (SELECT avg(tax) FROM trip_train)) AS tax_prediction FROM trip_predicted)"""


def trip_predicted(spark, folder):
    rows = random_split_hash(trip(spark, folder), TRIP_IDS)
    train, test = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    return joins.apply_group_stats(train, test, "l_partkey", {"net_prediction": "net", "tax_prediction": "tax"})


def _pair_sql(name: str, actual: str, prediction: str) -> str:
    e = f"({prediction} - {actual})"
    return (
        f"SELECT '{name}' AS target, count(*) AS row_count, avg(abs{e}) AS mae, sqrt(avg({e} * {e})) AS rmse, "
        f"1 - avg({e} * {e}) / var_pop({actual}) AS r2 FROM trip_filled"
    )


@query("multi_target_eval", f"WITH {_TRIP_PREDICTED_SQL} " + " UNION ALL ".join([
    _pair_sql("net", "net", "net_prediction"), _pair_sql("tax", "tax", "tax_prediction"),
    _pair_sql("amount", "amount", "(net_prediction + tax_prediction)"),
]), rounded="mae rmse r2", digits=5)
def multi_target_eval(spark, folder):
    pairs = {"net": "net_prediction", "tax": "tax_prediction"}
    return ev.multi_target_eval(trip_predicted(spark, folder), pairs, "amount")


@query("sum_of_targets", f"""
WITH {_TRIP_PREDICTED_SQL}
SELECT count(*) AS row_count, avg(net_prediction + tax_prediction) AS mean_total FROM trip_filled
""", rounded="mean_total", digits=5)
def sum_of_targets(spark, folder):
    summed = models.sum_of_targets(trip_predicted(spark, folder), ["net", "tax"])
    return summed.agg(F.count("*").alias("row_count"), F.avg("total_prediction").alias("mean_total"))


@query("part_sum_mae", f"""
WITH {TRIP_SQL} SELECT count(*) AS row_count,
  avg(abs(amount + CASE WHEN l_partkey % 13 = 0 THEN 0.05 ELSE 0 END - (net + tax))) AS component_sum_mae FROM trip
""", rounded="component_sum_mae")
def part_sum_mae(spark, folder):
    shifted = trip(spark, folder).withColumn(
        "amount", F.col("amount") + F.when(F.col("l_partkey") % 13 == 0, 0.05).otherwise(0.0)
    )
    return ev.part_sum_mae(shifted, ["net", "tax"], "amount")


@query("residual_summary", f"""
WITH {PREDICTED_SQL}, r AS (SELECT prediction - value AS residual FROM predicted),
b AS (SELECT quantile_cont(residual, 0.01) AS lo, quantile_cont(residual, 0.99) AS hi FROM r)
SELECT count(*) AS row_count, avg(residual) AS mean_residual, max(lo) AS lower_bound, max(hi) AS upper_bound,
       count(*) FILTER (WHERE residual BETWEEN lo AND hi) AS rows_inside,
       CAST(count(*) FILTER (WHERE residual BETWEEN lo AND hi) AS DOUBLE) / count(*) AS share_inside FROM r, b
""", rounded="mean_residual lower_bound upper_bound share_inside")
def residual_summary(spark, folder):
    return residuals(predicted(spark, folder), "value", "prediction")


# Result records: one run per event type, each scored on its own test rows ---------------

_RUNS_SQL = PREDICTED_SQL + f""", runs AS (
  SELECT event_type || '_user_mean_v1' AS experiment_id, event_type AS author,
         CASE WHEN event_type = 'signup' THEN 'other' ELSE 'value' END AS target, m.*,
         (SELECT count(*) FROM train t WHERE t.event_type = m.event_type) AS train_rows,
         CASE WHEN event_type = 'click' THEN NULL ELSE 0 END AS excluded_test_rows,
         event_type <> 'error' AS leakage_check
  FROM (SELECT event_type, {METRICS_SQL} FROM predicted GROUP BY 1) m)"""

SPLIT_ID = "hash_80_20_v1"


def runs(spark, folder):
    rows = events_split(spark, folder)
    train_rows = rows.where(F.col("split") == "train").groupBy("event_type").agg(
        F.count("*").alias("train_rows")
    )
    metrics = ev.regression_metrics(predicted(spark, folder), "value", "prediction", ["event_type"])
    kind = F.col("event_type")
    return metrics.join(train_rows, "event_type").select(
        F.concat(kind, F.lit("_user_mean_v1")).alias("experiment_id"),
        kind.alias("author"),
        F.when(kind == "signup", "other").otherwise("value").alias("target"),
        F.struct(*ev.METRICS).alias("metrics"),
        F.struct(
            "train_rows",
            F.col("row_count").alias("test_rows"),
            F.when(kind != "click", F.lit(0).cast("long")).alias("excluded_test_rows"),
            F.lit(SPLIT_ID).alias("split_id"),
            (kind != "error").alias("leakage_check"),
        ).alias("data"),
        F.lit(None).cast(res.RESULT_SCHEMA["fare_bands"].dataType).alias("fare_bands"),
        F.lit(None).cast(res.RESULT_SCHEMA["artifacts"].dataType).alias("artifacts"),
    )


_ELIGIBLE = (
    "(target = 'value' AND leakage_check AND coalesce(excluded_test_rows = 0, FALSE) AND row_count = "
    "(SELECT row_count FROM runs WHERE author = 'view'))"
)


@query("leaderboard", f"""
WITH {_RUNS_SQL}, flat AS (
  SELECT author, experiment_id, target, mae, rmse, median_ae, r2, train_rows, row_count AS test_rows,
         CAST(excluded_test_rows AS BIGINT) AS excluded_test_rows, leakage_check, {_ELIGIBLE} AS eligible FROM runs)
SELECT *, row_number() OVER (ORDER BY eligible DESC, mae, author, experiment_id) AS rank FROM flat
""", rounded="mae rmse median_ae r2")
def leaderboard(spark, folder):
    records = runs(spark, folder)
    pinned = records.where(F.col("author") == "view").first()["data"]["test_rows"]
    return res.leaderboard(records, "value", SPLIT_ID, pinned)


@query("leaderboard_rank", f"""
WITH {_RUNS_SQL} SELECT author, experiment_id, mae, author <> 'error' AS eligible,
  row_number() OVER (ORDER BY author <> 'error' DESC, mae, author) AS rank FROM runs
""", rounded="mae")
def leaderboard_rank(spark, folder):
    flat = runs(spark, folder).select(
        "author", "experiment_id", F.col("metrics.mae").alias("mae"), (F.col("author") != "error").alias("eligible")
    )
    return res.leaderboard_rank(flat)


@query("leaderboard_sort", f"""
WITH {_RUNS_SQL} SELECT author, mae, {_ELIGIBLE} AS eligible FROM runs ORDER BY eligible DESC, mae
""", rounded="mae")
def leaderboard_sort(spark, folder):
    return leaderboard(spark, folder).orderBy(F.desc("eligible"), "mae").select("author", "mae", "eligible")


@query("best_by_metric", f"""
WITH {_RUNS_SQL} SELECT author, mae FROM runs WHERE author <> 'error' ORDER BY mae, author LIMIT 1
""", rounded="mae")
def best_by_metric(spark, folder):
    flat = runs(spark, folder).select("author", F.col("metrics.mae").alias("mae"))
    return res.best_by_metric(flat, "author", "mae", ["error"])


@query("metric_sort", f"WITH {_RUNS_SQL} SELECT author, r2 FROM runs ORDER BY r2 DESC", rounded="r2")
def metric_sort(spark, folder):
    return res.metric_sort(runs(spark, folder).select("author", F.col("metrics.r2").alias("r2")))


@query("validate_result", f"""
WITH {_RUNS_SQL}, broken AS (
  SELECT CASE WHEN author = 'click' THEN '' ELSE experiment_id END AS experiment_id, author,
         CASE WHEN author = 'view' THEN NULL ELSE target END AS target,
         CASE WHEN author = 'error' THEN NULL ELSE rmse END AS rmse FROM runs)
SELECT experiment_id, author, 'experiment_id is empty' AS problem FROM broken WHERE experiment_id = ''
UNION ALL SELECT experiment_id, author, 'target is missing' FROM broken WHERE target IS NULL
UNION ALL SELECT experiment_id, author, 'metrics.rmse is missing' FROM broken WHERE rmse IS NULL
""")
def validate_result(spark, folder):
    author = F.col("author")
    rmse = F.when(author != "error", F.col("metrics.rmse"))
    broken = runs(spark, folder).withColumns({
        "experiment_id": F.when(author == "click", "").otherwise(F.col("experiment_id")),
        "target": F.when(author != "view", F.col("target")),
        "metrics": F.struct("metrics.mae", rmse.alias("rmse"), "metrics.median_ae", "metrics.r2"),
    })
    return res.result_violations(broken)


@query("scan_results_json", f"""
WITH {_RUNS_SQL} SELECT experiment_id, author, target, mae, r2, train_rows, row_count AS test_rows FROM runs
""", rounded="mae r2")
def scan_results_json(spark, folder):
    """Written by author, read back and validated."""
    saved = save_results(runs(spark, folder), scratch_path(spark, "results"))
    return saved.select(
        "experiment_id", "author", "target", F.col("metrics.mae").alias("mae"), F.col("metrics.r2").alias("r2"),
        F.col("data.train_rows").alias("train_rows"), F.col("data.test_rows").alias("test_rows"),
    )


@query("metrics_record", f"""
WITH {PREDICTED_SQL}, m AS (SELECT {METRICS_SQL} FROM predicted),
b AS (SELECT {_BAND} AS band, count(*) AS n FROM predicted GROUP BY 1)
SELECT 'user_mean_v1' AS experiment_id, mae, r2, row_count AS test_rows, (SELECT count(*) FROM train) AS train_rows,
       (SELECT count(*) FROM b) AS band_count, (SELECT CAST(sum(n) AS BIGINT) FROM b) AS band_rows,
       (SELECT string_agg(band, ',' ORDER BY band) FROM b) AS bands FROM m
""", rounded="mae r2")
def metrics_record(spark, folder):
    scored = predicted(spark, folder)
    train_rows = events_split(spark, folder).where(F.col("split") == "train").count()
    metrics = ev.regression_metrics(scored, "value", "prediction")
    record = res.metrics_record(
        metrics, ev.band_metrics(scored, "value", "prediction"), "user_mean_v1", "baseline", "value",
        train_rows, scored.count(), SPLIT_ID, True,
    )
    return record.select(
        "experiment_id", F.col("metrics.mae").alias("mae"), F.col("metrics.r2").alias("r2"),
        F.col("data.test_rows").alias("test_rows"), F.col("data.train_rows").alias("train_rows"),
        F.size("fare_bands").cast("long").alias("band_count"),
        F.aggregate("fare_bands", F.lit(0).cast("long"), lambda a, x: a + x["rows"]).alias("band_rows"),
        F.array_join(F.array_sort(F.transform("fare_bands", lambda x: x["fare_band"])), ",").alias("bands"),
    )


@query("roc_auc", f"""
WITH {TRIP_SQL}, ranked AS (
  SELECT CASE WHEN amount > 50000 THEN 1 ELSE 0 END AS label,
         rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS place FROM trip),
sums AS (SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
                sum(CASE WHEN label = 1 THEN place END) AS places FROM ranked)
SELECT positives + negatives AS row_count, positives, negatives,
       (places - positives * (positives + 1) / 2.0) / (positives * 1.0 * negatives) AS roc_auc FROM sums
""", rounded="roc_auc", digits=9)
def roc_auc(spark, folder):
    """How well the quantity, with its many ties, tells high amounts."""
    rows = trip(spark, folder).select("l_quantity", (F.col("amount") > 50_000).cast("int").alias("label"))
    return ev.roc_auc(rows, "label", "l_quantity")
