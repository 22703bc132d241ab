"""Profiles, missing values, duplicates, audited rules and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import features as feat
from ledgerline.operators import filters as flt
from ledgerline.operators import quality as q
from ledgerline.plans.bindings import (
    TRIP_IDS,
    TRIP_NULLS_SQL,
    TRIP_SQL,
    events,
    trip,
    trip_nulls,
)
from ledgerline.plans.registry import query
from ledgerline.sources.tables import table

NULLABLE = ["l_quantity", "l_tax", "l_returnflag"]
PROFILED = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "o_orderpriority", "o_totalprice",
]


def _profile_sql(source: str, rows: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", {i} AS position, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) AS row_count FROM {source}"
        for i, c in enumerate(PROFILED)
    ]
    return f"WITH {rows} " + " UNION ALL ".join(parts)


@query("profile_table", _profile_sql("trip_nulls", TRIP_NULLS_SQL))
def profile_table(spark, folder):
    return q.profile_table(trip_nulls(spark, folder).select(*PROFILED)).drop("dtype")


def _reconcile_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", (SELECT count(*) FILTER (WHERE {c} IS NULL) FROM trip) AS left_nulls, "
        f"(SELECT count(*) FILTER (WHERE {c} IS NULL) FROM trip_nulls) AS right_nulls, "
        f"(SELECT count(*) FROM trip) AS left_rows, (SELECT count(*) FROM trip_nulls) AS right_rows"
        for c in PROFILED
    ]
    return (
        f"WITH {TRIP_NULLS_SQL} SELECT *, left_nulls = right_nulls AND left_rows = right_rows AS same FROM ("
        + " UNION ALL ".join(parts) + ") t"
    )


@query("reconcile_tables", _reconcile_sql())
def reconcile_tables(spark, folder):
    return q.reconcile_tables(
        trip(spark, folder).select(*PROFILED), trip_nulls(spark, folder).select(*PROFILED)
    )


@query("reconcile_rows", """
SELECT event_type, user_id, CAST(sum(side) AS BIGINT) AS surplus FROM (
  SELECT event_type, user_id, 1 AS side FROM events
  UNION ALL SELECT event_type, user_id, -1 FROM events WHERE value <= 300) t
GROUP BY ALL HAVING sum(side) <> 0
""")
def reconcile_rows(spark, folder):
    e = events(spark, folder)
    cols = ["event_type", "user_id"]
    return q.row_differences(e.select(*cols), e.where(F.col("value") <= 300).select(*cols))


@query("reconcile_ranges", """
SELECT event_id, user_id, event_type, value, CAST(sum(side) AS BIGINT) AS surplus FROM (
  SELECT event_id, user_id, event_type, value, 1 AS side FROM events
  UNION ALL SELECT event_id, user_id, event_type, CASE WHEN event_id = 77 THEN value + 1 ELSE value END, -1 FROM events WHERE event_id <> 501) t
GROUP BY ALL HAVING sum(side) <> 0
""")
def reconcile_ranges(spark, folder):
    """One changed and one missing event, found by digests of key ranges."""
    e = events(spark, folder).select("event_id", "user_id", "event_type", "value")
    changed = e.where("event_id <> 501").withColumn("value", F.when(F.col("event_id") == 77, F.col("value") + 1).otherwise(F.col("value")))
    return q.reconcile_ranges(e, changed, "event_id")


def _missing_rate_sql() -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS missing_rate "
        "FROM trip_nulls"
        for c in PROFILED
    ]
    return f"WITH {TRIP_NULLS_SQL} SELECT * FROM (" + " UNION ALL ".join(parts) + ") t WHERE missing_rate > 0"


@query("missing_rate", _missing_rate_sql(), rounded="missing_rate")
def missing_rate(spark, folder):
    return q.missing_rate(trip_nulls(spark, folder), PROFILED)


_NULLS_SQL = (
    "(CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END + CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END"
    " + CASE WHEN l_returnflag IS NULL THEN 1 ELSE 0 END)"
)


@query("missing_pattern", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_NULLS_SQL} AS missing_column_count, count(*) AS row_count FROM trip_nulls GROUP BY 1
""")
def missing_pattern(spark, folder):
    return q.missing_pattern(trip_nulls(spark, folder), NULLABLE)


@query("missing_any_all", f"""
WITH {TRIP_NULLS_SQL}
SELECT count(*) AS row_count,
       count(*) FILTER (WHERE {_NULLS_SQL} > 0) AS any_missing,
       count(*) FILTER (WHERE {_NULLS_SQL} = 3) AS all_missing,
       count(*) FILTER (WHERE l_linestatus = 'F') AS flag_rows,
       count(*) FILTER (WHERE {_NULLS_SQL} > 0 AND l_linestatus = 'F') AS any_missing_and_flag
FROM trip_nulls
""")
def missing_any_all(spark, folder):
    return q.missing_any_all(trip_nulls(spark, folder), NULLABLE, F.col("l_linestatus") == "F")


@query("missing_by_group", f"""
WITH {TRIP_NULLS_SQL}
SELECT o_orderpriority, count(*) AS row_count,
       avg(CASE WHEN l_quantity IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS l_quantity_missing,
       avg(CASE WHEN l_tax IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS l_tax_missing,
       avg(CASE WHEN l_returnflag IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS l_returnflag_missing
FROM trip_nulls GROUP BY 1
""", rounded="l_quantity_missing l_tax_missing l_returnflag_missing")
def missing_by_group(spark, folder):
    return q.missing_by_group(trip_nulls(spark, folder), "o_orderpriority", NULLABLE)


@query("missing_after_join", """
SELECT source, count(*) AS row_count,
       avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS quality_missing,
       avg(CASE WHEN toxic IS NULL THEN 1.0 ELSE 0.0 END) * 100 AS toxic_missing
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""", rounded="quality_missing toxic_missing")
def missing_after_join(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "source")
    return q.missing_by_group(
        docs.join(table(spark, folder, "labels"), "doc_id", "left"), "source", ["quality", "toxic"]
    )


@query("duplicate_count", """
SELECT CAST(sum(c) AS BIGINT) AS row_count, CAST(sum(c - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS c FROM (
  SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem) t GROUP BY l_returnflag, l_linestatus, l_quantity) g
""")
def duplicate_count(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return q.duplicate_count(lines)


@query("dedup_keep_first", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS copy
  FROM events) t WHERE copy = 1
""")
def dedup_keep_first(spark, folder):
    dated = events(spark, folder).select(
        "event_id", "user_id", "event_type", "value", F.to_date("ts").alias("day")
    )
    return q.dedup_keep_first(dated, "event_id", ["user_id", "event_type", "day"]).drop("day")


@query("dedup_full_row", """
SELECT min(event_id) AS event_id, user_id, event_type FROM events GROUP BY user_id, event_type
""")
def dedup_full_row(spark, folder):
    return q.dedup_keep_first(events(spark, folder).select("event_id", "user_id", "event_type"), "event_id")


# Quality rules of the trip table, as (step, rule text).
AUDIT_STEPS = [
    ("Analysis period", "started_at >= TIMESTAMP '1993-01-01' AND started_at < TIMESTAMP '1998-01-01'"),
    ("Duration", "days BETWEEN 1 AND 180"),
    ("Quantity", "l_quantity BETWEEN 5 AND 45"),
    ("Quantity per day", "l_quantity / nullif(days, 0) <= 1"),
    ("Amount", "amount > 0"),
    ("Location code", "l_suppkey >= 1 AND l_partkey >= 1"),
]


def audit_rules() -> list[q.Rule]:
    conditions = [
        flt.in_period("started_at", "1993-01-01", "1998-01-01"),
        F.col("days").between(1, 180),
        F.col("l_quantity").between(5, 45),
        x.ratio("l_quantity", "days") <= 1,
        F.col("amount") > 0,
        (F.col("l_suppkey") >= 1) & (F.col("l_partkey") >= 1),
    ]
    return [q.Rule(step, rule, keep) for (step, rule), keep in zip(AUDIT_STEPS, conditions, strict=True)]


_FIRST_FAILED_SQL = "CASE " + " ".join(
    f"WHEN NOT coalesce({rule}, FALSE) THEN {i + 1}" for i, (_, rule) in enumerate(AUDIT_STEPS)
) + " ELSE 0 END"
_STEPS_SQL = ", ".join(
    "({}, '{}', '{}')".format(i + 1, step, rule.replace("'", "''")) for i, (step, rule) in enumerate(AUDIT_STEPS)
)

AUDIT_SQL = f"""
WITH {TRIP_NULLS_SQL},
marked AS (SELECT {_FIRST_FAILED_SQL} AS failed FROM trip_nulls),
steps(step_order, step, rule) AS (VALUES {_STEPS_SQL}),
removed AS (
  SELECT step_order, step, rule, (SELECT count(*) FROM marked WHERE failed = step_order) AS removed_rows FROM steps),
running AS (SELECT *, sum(removed_rows) OVER (ORDER BY step_order) AS gone FROM removed)
SELECT step_order, step, rule,
       CAST((SELECT count(*) FROM marked) - gone + removed_rows AS BIGINT) AS before_rows,
       removed_rows,
       CAST((SELECT count(*) FROM marked) - gone AS BIGINT) AS after_rows
FROM running
"""


@query("filter_audit", AUDIT_SQL)
def filter_audit(spark, folder):
    return q.filter_audit(trip_nulls(spark, folder), audit_rules())


@query("audit_running_rows", """
WITH removed AS (SELECT event_type, count(*) AS removed_rows FROM events GROUP BY 1)
SELECT event_type, removed_rows,
       CAST((SELECT count(*) FROM events) - sum(removed_rows) OVER (ORDER BY event_type) + removed_rows AS BIGINT)
         AS before_rows,
       CAST((SELECT count(*) FROM events) - sum(removed_rows) OVER (ORDER BY event_type) AS BIGINT) AS after_rows
FROM removed
""")
def audit_running_rows(spark, folder):
    e = events(spark, folder)
    counted = e.groupBy("event_type").agg(F.count("*").alias("removed_rows"))
    return q.audit_running_rows(counted, "event_type", "removed_rows", e.count())


@query("clean_summary", f"""
WITH {TRIP_NULLS_SQL},
marked AS (SELECT *, {_FIRST_FAILED_SQL.replace('l_quantity BETWEEN 5 AND 45', 'l_linenumber >= 1').replace(
    'l_quantity / nullif(days, 0) <= 1', 'days <= 150')} = 0 AS valid FROM trip_nulls),
counted AS (SELECT count(*) AS raw_rows, count(*) FILTER (WHERE valid) AS valid_rows,
  count(*) FILTER (WHERE valid AND l_quantity IS NULL) AS original_missing_rows,
  count(*) FILTER (WHERE valid AND l_quantity NOT BETWEEN 1 AND 40) AS reclassified_rows,
  count(*) FILTER (WHERE valid AND amount >= 50000) AS positive_label_rows FROM marked)
SELECT raw_rows, valid_rows, raw_rows - valid_rows AS removed_rows,
       valid_rows / raw_rows AS retention_rate, original_missing_rows, reclassified_rows,
       original_missing_rows + reclassified_rows AS rows_for_imputation, positive_label_rows,
       positive_label_rows / valid_rows AS positive_label_rate
FROM counted
""", rounded="retention_rate positive_label_rate")
def clean_summary(spark, folder):
    rules = audit_rules()
    rules[2] = q.Rule("Line", "l_linenumber >= 1", F.col("l_linenumber") >= 1)
    rules[3] = q.Rule("Late", "days <= 150", F.col("days") <= 150)
    return q.clean_summary(
        trip_nulls(spark, folder), rules, "l_quantity", (1, 40), x.threshold_label("amount", 50000)
    )


@query("rule_violations", f"""
WITH {TRIP_SQL}
SELECT count(*) AS row_count,
       count(*) FILTER (WHERE days <= 0) AS days_not_positive_rows,
       count(*) FILTER (WHERE days > 180) AS days_over_limit_rows,
       count(*) FILTER (WHERE l_quantity > 45) AS quantity_over_limit_rows,
       count(*) FILTER (WHERE l_discount = 0) AS discount_zero_rows,
       min(days) AS days_min, min(l_quantity) AS l_quantity_min,
       max(days) AS days_max, max(l_quantity) AS l_quantity_max
FROM trip
""", rounded="days_min days_max")
def rule_violations(spark, folder):
    return q.rule_violations(
        trip(spark, folder),
        {
            "days_not_positive": F.col("days") <= 0,
            "days_over_limit": F.col("days") > 180,
            "quantity_over_limit": F.col("l_quantity") > 45,
            "discount_zero": F.col("l_discount") == 0,
        },
        ["days", "l_quantity"],
    )


@query("exclusion_overlap", """
SELECT count(*) FILTER (WHERE NOT (ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25')) AS outside_period_rows,
       count(*) FILTER (WHERE value - 20 < 0) AS negative_rows,
       count(*) FILTER (WHERE event_type = 'error') AS voided_rows,
       count(*) FILTER (WHERE value - 20 < 0 AND event_type = 'error') AS overlap_rows,
       count(*) FILTER (WHERE value > 150) AS over_limit_rows,
       count(*) FILTER (WHERE value - 20 < 0 OR event_type = 'error' OR value > 150) AS unique_excluded_rows
FROM events
""")
def exclusion_overlap(spark, folder):
    e = events(spark, folder).withColumn("shifted", F.col("value") - 20)
    return q.exclusion_overlap(
        e,
        q.negative_in(["shifted"]),
        F.col("event_type") == "error",
        q.over_limit({"value": 150}),
        ~flt.in_period("ts", "2024-01-05", "2024-01-25"),
    )


@query("sum_consistency", f"""
WITH {TRIP_NULLS_SQL},
shifted AS (SELECT net, CASE WHEN l_tax IS NULL THEN NULL ELSE tax END AS tax,
                   amount + CASE WHEN l_partkey % 13 = 0 THEN 0.05 ELSE 0 END AS total FROM trip_nulls)
SELECT count(*) AS row_count, avg(abs(total - (net + tax))) AS mean_absolute_difference,
       avg(CASE WHEN abs(total - (net + tax)) <= 0.01 THEN 1.0 ELSE 0.0 END) AS within_tolerance_ratio
FROM shifted WHERE tax IS NOT NULL
""", rounded="mean_absolute_difference within_tolerance_ratio")
def sum_consistency(spark, folder):
    shifted = trip_nulls(spark, folder).withColumns({
        "tax": F.when(F.col("l_tax").isNotNull(), F.col("tax")),
        "total": F.col("amount") + F.when(F.col("l_partkey") % 13 == 0, 0.05).otherwise(0.0),
    })
    return q.sum_consistency(shifted, ["net", "tax"], "total")


@query("assert_no_nulls", f"""
WITH {TRIP_NULLS_SQL}
SELECT CAST(count(*) FILTER (WHERE coalesce(l_quantity, -1) IS NULL) +
       count(*) FILTER (WHERE coalesce(l_tax, 0) IS NULL) +
       count(*) FILTER (WHERE coalesce(l_returnflag, 'Unknown') IS NULL) AS BIGINT) AS null_cells
FROM trip_nulls
""")
def assert_no_nulls(spark, folder):
    filled = feat.fill_constants(
        trip_nulls(spark, folder).select(*PROFILED),
        {"l_quantity": -1.0, "l_tax": 0.0, "l_returnflag": "Unknown"},
    )
    return q.null_cells(q.assert_no_nulls(filled))


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice"]


@query("require_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def require_columns(spark, folder):
    orders = table(spark, folder, "orders")
    q.require_columns(orders, _ORDER_COLUMNS)
    return orders.select(*_ORDER_COLUMNS)


@query("resolve_columns", "SELECT l_orderkey, l_tax FROM lineitem")
def resolve_columns(spark, folder):
    """Names in any case; the absent one is skipped with a warning."""
    lines = table(spark, folder, "lineitem")
    return lines.select(*q.resolve_columns(lines, ["L_ORDERKEY", "L_Tax", "l_absent"]))


@query("leakage_guard", "SELECT l_quantity, l_extendedprice, l_discount FROM lineitem")
def leakage_guard(spark, folder):
    features = ["l_quantity", "l_extendedprice", "l_discount"]
    q.leakage_guard(features, ["net", "tax", "amount"], features)
    return table(spark, folder, "lineitem").select(*features)


@query("expected_rows", "SELECT count(*) AS row_count FROM orders")
def expected_rows(spark, folder):
    """The key is unique, so distinct keys must be as many as rows."""
    orders = table(spark, folder, "orders").select("o_orderkey")
    counted = orders.agg(F.count("*").alias("row_count"))
    q.expected_rows(orders.distinct(), counted.first()["row_count"], "orders")
    return counted


# Filters -------------------------------------------------------------------------------

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("period_filter", "SELECT event_id, value FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'")
def period_filter(spark, folder):
    e = events(spark, folder)
    return flt.period_filter(e, "ts", "2024-01-10", "2024-01-20", fail_if_empty=True).select("event_id", "value")


@query("positive_target", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def positive_target(spark, folder):
    return flt.positive_target(table(spark, folder, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("range_filters", f"""
WITH {TRIP_SQL} SELECT {_KEYS}, days FROM trip
WHERE days BETWEEN 1 AND 180 AND l_quantity BETWEEN 5 AND 45 AND l_discount BETWEEN 0.02 AND 0.08
""", rounded="days")
def range_filters(spark, folder):
    ranges = {"days": (1, 180), "l_quantity": (5, 45), "l_discount": (0.02, 0.08)}
    return flt.range_filters(trip(spark, folder), ranges).select(*TRIP_IDS, "days")


@query("all_nonneg_or_null", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, days, l_quantity - 10 AS spare FROM trip_nulls
WHERE (days >= 0 OR days IS NULL) AND (l_quantity - 10 >= 0 OR l_quantity IS NULL)
""", rounded="days")
def all_nonneg_or_null(spark, folder):
    spare = trip_nulls(spark, folder).withColumn("spare", F.col("l_quantity") - 10)
    return flt.all_nonneg_or_null(spare, ["days", "spare"]).select(*TRIP_IDS, "days", "spare")


@query("within_limits_or_null", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, l_quantity, l_tax FROM trip_nulls
WHERE (l_quantity <= 30 OR l_quantity IS NULL) AND (l_tax <= 0.05 OR l_tax IS NULL) AND l_extendedprice <= 60000
""")
def within_limits_or_null(spark, folder):
    limits = {"l_quantity": 30, "l_tax": 0.05, "l_extendedprice": 60000}
    return flt.within_limits(trip_nulls(spark, folder), limits).select(*TRIP_IDS, "l_quantity", "l_tax")


@query("not_code_or_null", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, l_returnflag FROM trip_nulls WHERE l_returnflag <> 'R' OR l_returnflag IS NULL
""")
def not_code_or_null(spark, folder):
    return flt.not_code(trip_nulls(spark, folder), "l_returnflag", "R").select(*TRIP_IDS, "l_returnflag")


@query("clean_trips", f"""
WITH {TRIP_NULLS_SQL},
firsts AS (SELECT min(l_linenumber) AS l_linenumber, l_orderkey, trim(l_linestatus) AS l_linestatus,
                  l_returnflag, l_quantity, days, l_tax, started_at
           FROM trip_nulls GROUP BY ALL)
SELECT l_linenumber, l_orderkey, l_linestatus, l_returnflag, l_quantity, days, l_tax,
       hour(started_at) AS pickup_hour, isodow(started_at) - 1 AS pickup_weekday,
       CASE WHEN isodow(started_at) >= 6 THEN 1 ELSE 0 END AS is_weekend
FROM firsts
WHERE days BETWEEN 1 AND 120 AND (l_quantity >= 0 OR l_quantity IS NULL)
  AND started_at >= TIMESTAMP '1993-01-01' AND started_at < TIMESTAMP '1998-01-01'
  AND (l_quantity <= 45 OR l_quantity IS NULL) AND (l_tax <= 0.07 OR l_tax IS NULL)
  AND (l_returnflag <> 'R' OR l_returnflag IS NULL)
""", rounded="days")
def clean_trips(spark, folder):
    trimmed = trip_nulls(spark, folder).select(
        "l_linenumber", "l_orderkey", F.trim("l_linestatus").alias("l_linestatus"), "l_returnflag",
        "l_quantity", "days", "l_tax", "started_at",
    )
    cleaned = flt.range_filters(trimmed, {"days": (1, 120)})
    cleaned = flt.period_filter(cleaned, "started_at", "1993-01-01", "1998-01-01")
    cleaned = flt.all_nonneg_or_null(cleaned, ["l_quantity"])
    cleaned = flt.within_limits(cleaned, {"l_quantity": 45, "l_tax": 0.07})
    cleaned = flt.not_code(cleaned, "l_returnflag", "R")
    # The rules read only compared columns, so copies fall together and can be dropped last.
    unique = q.dedup_keep_first(cleaned, "l_linenumber")
    return feat.time_features(unique, "started_at").drop("started_at")


@query("quantile_cap_filter", f"""
WITH {TRIP_SQL}, kept AS (SELECT * FROM trip WHERE days > 0 AND l_quantity > 0)
SELECT {_KEYS}, days FROM kept WHERE days <= (SELECT quantile_cont(days, 0.995) FROM kept)
""", rounded="days")
def quantile_cap_filter(spark, folder):
    kept = trip(spark, folder).where((F.col("days") > 0) & (F.col("l_quantity") > 0))
    return flt.quantile_cap_filter(kept, "days", 0.995).select(*TRIP_IDS, "days")


@query("drop_null_targets", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, l_quantity, l_tax FROM trip_nulls WHERE l_quantity IS NOT NULL AND l_returnflag IS NOT NULL
""")
def drop_null_targets(spark, folder):
    kept = flt.drop_null_targets(trip_nulls(spark, folder), ["l_quantity", "l_returnflag"])
    return kept.select(*TRIP_IDS, "l_quantity", "l_tax")


@query("trim_quantile_band", """
SELECT event_id, value FROM events
WHERE value >= (SELECT quantile_cont(value, 0.01) FROM events)
  AND value <= (SELECT quantile_cont(value, 0.99) FROM events)
""")
def trim_quantile_band(spark, folder):
    return flt.trim_quantile_band(events(spark, folder).select("event_id", "value"), "value")
