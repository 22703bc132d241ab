"""Grouped summaries and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.expressions import WEEKDAY_LABELS
from ledgerline.functions.quantiles import quantile_values
from ledgerline.operators import eda
from ledgerline.operators import filters as flt
from ledgerline.operators.statistics import correlation_matrix
from ledgerline.plans.bindings import (
    EVENTS_SPLIT_SQL,
    TRIP_NULLS_SQL,
    TRIP_SQL,
    events,
    events_split,
    trip,
    trip_nulls,
)
from ledgerline.plans.catalog.features import PRIORITY_LABELS
from ledgerline.plans.registry import query
from ledgerline.sources.tables import table

_MONTH = "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' AND value > 0"


def _month(spark, folder):
    return flt.positive_target(
        flt.period_filter(events(spark, folder), "ts", "2024-01-01", "2024-02-01"), "value"
    )


@query("hourly_amount", f"""
SELECT hour(ts) AS pickup_hour, avg(value) AS mean_amount, quantile_cont(value, 0.5) AS median_amount,
       count(*) AS row_count FROM events WHERE {_MONTH} GROUP BY 1
""", rounded="mean_amount median_amount")
def hourly_amount(spark, folder):
    return eda.hourly_amount(_month(spark, folder), "ts", "value")


@query("hourly_volume", f"""
SELECT hour(ts) AS pickup_hour, count(*) AS row_count, avg(value) AS mean_value, avg(user_id) AS mean_user
FROM events WHERE {_MONTH} GROUP BY 1
""", rounded="mean_value mean_user")
def hourly_volume(spark, folder):
    return eda.hourly_volume(_month(spark, folder), "ts", {"mean_value": "value", "mean_user": "user_id"})


_WEEKDAY_CASE = "CASE isodow(ts) - 1 " + " ".join(
    f"WHEN {k} THEN '{v}'" for k, v in WEEKDAY_LABELS.items()
) + " END"


@query("weekday_hour_amount", f"""
WITH parts AS (
  SELECT ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS a,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE value / 2 END AS b FROM events),
summed AS (SELECT ts, CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) END AS s FROM parts)
SELECT isodow(ts) - 1 AS pickup_weekday, hour(ts) AS pickup_hour, avg(s) AS mean_sum, count(s) AS sum_count,
       {_WEEKDAY_CASE} AS weekday FROM summed GROUP BY ALL
""", rounded="mean_sum")
def weekday_hour_amount(spark, folder):
    parts = events(spark, folder).select(
        "ts",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("a"),
        F.when(F.col("event_id") % 5 != 0, F.col("value") / 2).alias("b"),
    )
    return eda.weekday_hour_amount(parts, "ts", ["a", "b"])


_PRIORITY_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_LABELS.items()
) + " ELSE 'Other' END"


@query("code_counts", f"""
SELECT o_orderpriority, count(*) AS row_count, {_PRIORITY_CASE} AS label FROM orders GROUP BY 1
""")
def code_counts(spark, folder):
    return eda.code_counts(table(spark, folder, "orders"), "o_orderpriority", PRIORITY_LABELS)


@query("group_mean", """
SELECT CASE WHEN isodow(ts) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_kind, avg(value) AS mean_value
FROM events GROUP BY 1
""", rounded="mean_value")
def group_mean(spark, folder):
    weekend = (F.weekday("ts") >= 5).cast("int")
    return eda.group_mean(events(spark, folder), weekend, "value", {0: "weekday", 1: "weekend"}, "day_kind")


PARTS = ["l_quantity", "days", "l_discount", "l_tax"]


@query("component_means", f"WITH {TRIP_NULLS_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS component, avg({c}) AS mean_value FROM trip_nulls" for c in PARTS
), rounded="mean_value")
def component_means(spark, folder):
    return eda.component_means(trip_nulls(spark, folder), PARTS)


@query("zero_ratio", f"WITH {TRIP_NULLS_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS component, avg(CASE WHEN {c} = 0 THEN 1.0 ELSE 0.0 END) AS zero_ratio FROM trip_nulls"
    for c in PARTS
), rounded="zero_ratio")
def zero_ratio(spark, folder):
    return eda.zero_ratio(trip_nulls(spark, folder), PARTS)


@query("nonzero_ratio", f"WITH {TRIP_NULLS_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS component, count({c}) AS row_count, avg({c}) AS mean_value, "
    f"avg(CASE WHEN {c} <> 0 THEN 1.0 ELSE 0.0 END) FILTER (WHERE {c} IS NOT NULL) AS nonzero_rate FROM trip_nulls"
    for c in PARTS
), rounded="mean_value nonzero_rate")
def nonzero_ratio(spark, folder):
    return eda.nonzero_ratio(trip_nulls(spark, folder), PARTS)


@query("target_moments", f"""
WITH {EVENTS_SPLIT_SQL}
SELECT split, count(*) AS row_count, avg(value) AS target_mean, max(value) AS target_max FROM events_split GROUP BY 1
""", rounded="target_mean")
def target_moments(spark, folder):
    return eda.target_moments(events_split(spark, folder), "split", "value")


@query("macro_average", """
WITH m AS (SELECT event_type, avg(value) AS mean_value, stddev_samp(value) AS std_value FROM events GROUP BY 1)
SELECT count(*) AS targets, avg(mean_value) AS mean_value, avg(std_value) AS std_value FROM m
""", rounded="mean_value std_value")
def macro_average(spark, folder):
    metrics = events(spark, folder).groupBy("event_type").agg(
        F.avg("value").alias("mean_value"), F.stddev_samp("value").alias("std_value")
    )
    return eda.macro_average(metrics, ["mean_value", "std_value"])


def _histogram_sql(source: str, value: str, low: str, high: str, bins: int, with_rows: str = "") -> str:
    return f"""
WITH {with_rows} limits AS (SELECT {low} AS lo, ({high} - {low}) / {bins} AS w, {high} AS hi),
counted AS (
  SELECT least(CAST(floor(({value} - lo) / w) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
  FROM {source}, limits WHERE {value} BETWEEN lo AND hi GROUP BY 1)
SELECT b.bin, lo + b.bin * w AS bin_start, lo + (b.bin + 1) * w AS bin_end, coalesce(n, 0) AS row_count
FROM range({bins}) b(bin) CROSS JOIN limits LEFT JOIN counted c ON b.bin = c.bin
"""


@query("histogram", _histogram_sql("events", "least(value, 100.0)", "0.0::DOUBLE", "100.0::DOUBLE", 60),
       rounded="bin_start bin_end")
def histogram(spark, folder):
    return eda.histogram(
        events(spark, folder).select(F.least("value", F.lit(100.0)).alias("value")), "value", 0.0, 100.0, 60
    )


@query("histogram_trimmed", _histogram_sql(
    "events", "value", "(SELECT quantile_cont(value, 0.01) FROM events)",
    "(SELECT quantile_cont(value, 0.99) FROM events)", 80), rounded="bin_start bin_end")
def histogram_trimmed(spark, folder):
    values = events(spark, folder).select("value")
    low, high = quantile_values(values, "value", [0.01, 0.99])
    return eda.histogram(values, "value", low, high, 80)


def _heatmap_sql() -> str:
    columns = ["l_quantity", "l_extendedprice", "days", "amount"]
    return f"WITH {TRIP_SQL} " + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + ("1.0::DOUBLE" if a == b else f"corr({a}, {b})") + " AS r FROM trip"
        + (" LIMIT 1" if a == b else "")
        for a in columns for b in columns
    ).replace(" LIMIT 1", " GROUP BY 1, 2, 3")


@query("heatmap_long", _heatmap_sql(), rounded="r")
def heatmap_long(spark, folder):
    return correlation_matrix(trip(spark, folder), ["l_quantity", "l_extendedprice", "days", "amount"])


@query("series_tables", f"""
SELECT 'hour' AS series, CAST(hour(ts) AS VARCHAR) AS label, count(*) AS row_count, avg(value) AS mean_value
FROM events WHERE {_MONTH} GROUP BY ALL
UNION ALL SELECT 'event_type', event_type, count(*), avg(value) FROM events WHERE {_MONTH} GROUP BY ALL
UNION ALL SELECT 'weekday', CAST(isodow(ts) - 1 AS VARCHAR), count(*), avg(value) FROM events WHERE {_MONTH} GROUP BY ALL
""", rounded="mean_value")
def series_tables(spark, folder):
    month = _month(spark, folder)
    series = {"hour": F.hour("ts"), "event_type": F.col("event_type"), "weekday": F.weekday("ts")}
    points = month.select(
        "value",
        F.inline(F.array(*[
            F.struct(F.lit(name).alias("series"), label.cast("string").alias("label"))
            for name, label in series.items()
        ])),
    )
    return points.groupBy("series", "label").agg(
        F.count("*").alias("row_count"), F.avg("value").alias("mean_value")
    )
