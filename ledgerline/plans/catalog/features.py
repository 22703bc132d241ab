"""Row-local feature expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import features as feat
from ledgerline.plans.bindings import TRIP_IDS, TRIP_NULLS_SQL, TRIP_SQL, events, trip, trip_nulls
from ledgerline.plans.registry import query
from ledgerline.sources.tables import table

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# Labels of the order priorities; the last one is left to the fallback.
PRIORITY_LABELS = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "5-LOW": "low"}
_PRIORITY_CASE = "CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in PRIORITY_LABELS.items()
) + " ELSE 'Other' END"


@query("duration_minutes", f"WITH {TRIP_SQL} SELECT {_KEYS}, days * 1440.0 AS minutes FROM trip", rounded="minutes")
def duration_minutes(spark, folder):
    return trip(spark, folder).select(*TRIP_IDS, x.duration("started_at", "ended_at").alias("minutes"))


@query("time_parts", """
SELECT event_id, hour(ts) AS pickup_hour, isodow(ts) - 1 AS pickup_weekday,
       CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS is_weekend FROM events
""")
def time_parts(spark, folder):
    return feat.time_features(events(spark, folder).select("event_id", "ts"), "ts").drop("ts")


@query("clip_keep_null", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, CASE WHEN l_quantity IS NULL THEN NULL ELSE least(greatest(l_quantity, 5.0), 40.0) END AS quantity,
       least(greatest(days, 1.0), 180.0) AS days
FROM trip_nulls
""", rounded="days")
def clip_keep_null(spark, folder):
    return trip_nulls(spark, folder).select(
        *TRIP_IDS, x.clip("l_quantity", 5, 40).alias("quantity"), x.clip("days", 1, 180).alias("days")
    )


@query("adjust_indicators", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS},
       CASE WHEN l_quantity IS NULL THEN NULL ELSE least(greatest(l_quantity, 0.0), 40.0) END AS l_quantity,
       CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS quantity_was_capped,
       CASE WHEN l_quantity = 0 THEN 1 ELSE 0 END AS quantity_is_zero,
       CASE WHEN days < 1 OR days > 180 THEN 1 ELSE 0 END AS days_was_adjusted
FROM trip_nulls
""")
def adjust_indicators(spark, folder):
    flagged = feat.clip_with_flags(
        trip_nulls(spark, folder), "l_quantity", 0, 40, capped="quantity_was_capped", zero="quantity_is_zero"
    )
    flagged = feat.clip_with_flags(flagged, "days", 1, 180, adjusted="days_was_adjusted")
    return flagged.select(*TRIP_IDS, "l_quantity", "quantity_was_capped", "quantity_is_zero", "days_was_adjusted")


@query("fill_constants", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, coalesce(l_quantity, -1) AS l_quantity, coalesce(l_tax, 0.0) AS l_tax,
       coalesce(l_returnflag, 'Unknown') AS l_returnflag FROM trip_nulls
""")
def fill_constants(spark, folder):
    rows = trip_nulls(spark, folder).select(*TRIP_IDS, "l_quantity", "l_tax", "l_returnflag")
    return feat.fill_constants(rows, {"l_quantity": -1.0, "l_tax": 0.0, "l_returnflag": "Unknown"})


@query("missing_flags", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, l_quantity IS NULL AS l_quantity_was_missing, l_returnflag IS NULL AS l_returnflag_was_missing
FROM trip_nulls
""")
def missing_flags(spark, folder):
    flagged = feat.missing_flags(trip_nulls(spark, folder), ["l_quantity", "l_returnflag"])
    return flagged.select(*TRIP_IDS, "l_quantity_was_missing", "l_returnflag_was_missing")


@query("invalid_to_null", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, CASE WHEN l_quantity BETWEEN 1 AND 40 THEN l_quantity END AS l_quantity FROM trip_nulls
""")
def invalid_to_null(spark, folder):
    return trip_nulls(spark, folder).select(*TRIP_IDS, x.invalid_to_null("l_quantity", 1, 40).alias("l_quantity"))


@query("cyclic_time", """
SELECT event_id, sin(2 * pi() * hour(ts) / 24) AS pickup_hour_sin, cos(2 * pi() * hour(ts) / 24) AS pickup_hour_cos,
       sin(2 * pi() * (isodow(ts) - 1) / 7) AS pickup_dayofweek_sin,
       cos(2 * pi() * (isodow(ts) - 1) / 7) AS pickup_dayofweek_cos FROM events
""", rounded="pickup_hour_sin pickup_hour_cos pickup_dayofweek_sin pickup_dayofweek_cos", digits=9)
def cyclic_time(spark, folder):
    return feat.cyclic_features(events(spark, folder).select("event_id", "ts"), "ts").drop("ts")


_PERIOD_CASE = (
    "CASE WHEN hour(ts) <= 5 THEN 'night' WHEN hour(ts) <= 9 THEN 'morning_peak' "
    "WHEN hour(ts) <= 15 THEN 'daytime' WHEN hour(ts) <= 19 THEN 'evening_peak' ELSE 'late_evening' END"
)


@query("time_of_day_bucket", f"SELECT event_id, {_PERIOD_CASE} AS pickup_period FROM events")
def time_of_day_bucket(spark, folder):
    return events(spark, folder).select("event_id", x.day_period(F.hour("ts")).alias("pickup_period"))


@query("value_band", """
SELECT event_id, CASE WHEN value < 30 THEN 'under_30' WHEN value < 60 THEN '30_to_60'
                      WHEN value < 100 THEN '60_to_100' ELSE '100_plus' END AS band FROM events
""")
def value_band(spark, folder):
    band = x.value_band("value", [30, 60, 100], ["under_30", "30_to_60", "60_to_100", "100_plus"])
    return events(spark, folder).select("event_id", band.alias("band"))


@query("composite_key", f"""
SELECT event_id, user_id || '_' || event_type AS route_id,
       user_id || '_' || event_type || '_' || {_PERIOD_CASE} AS route_period_id FROM events
""")
def composite_key(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "event_type", "ts")
    return feat.route_features(rows, "user_id", "event_type", "ts").select(
        "event_id", "route_id", "route_period_id"
    )


@query("ratio_speed", f"""
WITH {TRIP_SQL} SELECT {_KEYS}, l_quantity / nullif(days / 30.0, 0) AS per_month FROM trip
""", rounded="per_month")
def ratio_speed(spark, folder):
    return trip(spark, folder).select(*TRIP_IDS, x.ratio("l_quantity", F.col("days") / 30.0).alias("per_month"))


@query("threshold_label", "SELECT event_id, CASE WHEN value >= 100 THEN 1 ELSE 0 END AS high_value FROM events")
def threshold_label(spark, folder):
    return events(spark, folder).select("event_id", x.threshold_label("value", 100.0).alias("high_value"))


@query("membership_flag", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_suppkey IN (1, 32, 38) OR l_linenumber IN (1, 32, 38) THEN 1 ELSE 0 END AS is_hub FROM lineitem
""")
def membership_flag(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select(*TRIP_IDS, x.membership_flag(["l_suppkey", "l_linenumber"], [1, 32, 38]).alias("is_hub"))


@query("row_sum", f"""
WITH {TRIP_NULLS_SQL},
parts AS (SELECT *, CASE WHEN l_tax IS NULL THEN NULL ELSE tax END AS t,
                 CASE WHEN l_returnflag IS NULL THEN NULL ELSE net END AS n FROM trip_nulls)
SELECT {_KEYS}, coalesce(t, 0) + coalesce(n, 0) AS sum_zero,
       CASE WHEN t IS NOT NULL OR n IS NOT NULL THEN coalesce(t, 0) + coalesce(n, 0) END AS sum_any,
       t + n AS sum_all FROM parts
""", rounded="sum_zero sum_any sum_all")
def row_sum(spark, folder):
    parts = trip_nulls(spark, folder).withColumns({
        "t": F.when(F.col("l_tax").isNotNull(), F.col("tax")),
        "n": F.when(F.col("l_returnflag").isNotNull(), F.col("net")),
    })
    return parts.select(
        *TRIP_IDS,
        x.row_sum(["t", "n"], "zero").alias("sum_zero"),
        x.row_sum(["t", "n"], "any").alias("sum_any"),
        x.row_sum(["t", "n"], "all").alias("sum_all"),
    )


@query("label_lookup", f"SELECT o_orderkey, {_PRIORITY_CASE} AS label FROM orders")
def label_lookup(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", x.label_lookup("o_orderpriority", PRIORITY_LABELS).alias("label")
    )


@query("label_table_join", """
SELECT c_custkey, coalesce(r_name, 'Other') AS r_name
FROM customer LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
                         WHERE n_regionkey < 4) n ON c_nationkey = n_nationkey
""")
def label_table_join(spark, folder):
    regions = table(spark, folder, "region").where(F.col("r_regionkey") < 4)
    labels = table(spark, folder, "nation").join(
        regions, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return feat.label_table_join(customers, "c_nationkey", labels, "r_name").drop("c_nationkey")


@query("trim_string", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, trim(' ' || l_returnflag || '  ') AS flag FROM lineitem
""")
def trim_string(spark, folder):
    padded = F.concat(F.lit(" "), "l_returnflag", F.lit("  "))
    return table(spark, folder, "lineitem").select(*TRIP_IDS, F.trim(padded).alias("flag"))


@query("coerce_types", """
WITH texts AS (
  SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value_text,
         CASE WHEN event_id % 10 = 0 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts_text
  FROM events)
SELECT event_id, TRY_CAST(value_text AS DOUBLE) AS value,
       CAST(epoch(TRY_CAST(ts_text AS TIMESTAMP)) AS BIGINT) AS ts_seconds FROM texts
""")
def coerce_types(spark, folder):
    texts = events(spark, folder).select(
        "event_id",
        F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("value_text"),
        F.when(F.col("event_id") % 10 == 0, "not a time")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("ts_text"),
    )
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return texts.select(
        "event_id",
        x.coerce_number("value_text").alias("value"),
        F.timestamp_diff("SECOND", start, x.coerce_timestamp("ts_text")).alias("ts_seconds"),
    )


@query("flag_equals", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returnflag_r FROM trip_nulls
""")
def flag_equals(spark, folder):
    return trip_nulls(spark, folder).select(*TRIP_IDS, x.flag_equals("l_returnflag", "R").alias("returnflag_r"))


@query("one_hot_columns", """
SELECT event_id, value,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS event_type_click,
       CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS event_type_error,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS event_type_purchase,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS event_type_signup,
       CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS event_type_view
FROM events
""")
def one_hot_columns(spark, folder):
    return feat.one_hot_columns(events(spark, folder).select("event_id", "value", "event_type"), ["event_type"])


@query("one_hot_long", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, 'l_returnflag' AS "column", l_returnflag AS value FROM trip_nulls
UNION ALL SELECT {_KEYS}, 'l_linestatus', l_linestatus FROM trip_nulls
""")
def one_hot_long(spark, folder):
    return feat.one_hot_long(trip_nulls(spark, folder), TRIP_IDS, ["l_returnflag", "l_linestatus"])


@query("drop_columns", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def drop_columns(spark, folder):
    return feat.drop_columns(
        table(spark, folder, "lineitem"), [*TRIP_IDS, "l_returnflag", "l_linestatus", "l_shipdate"]
    )


@query("select_features", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS},
       CASE WHEN l_quantity IS NULL THEN NULL ELSE least(greatest(l_quantity, 0.0), 40.0) END AS quantity,
       least(greatest(days, 1.0), 180.0) AS days, month(started_at) AS start_month,
       isodow(started_at) - 1 AS start_weekday,
       CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END AS quantity_was_capped,
       CASE WHEN l_quantity = 0 THEN 1 ELSE 0 END AS quantity_is_zero,
       CASE WHEN days < 1 OR days > 180 THEN 1 ELSE 0 END AS days_was_adjusted,
       l_returnflag, l_linestatus, o_orderpriority
FROM trip_nulls
""", rounded="days")
def select_features(spark, folder):
    days = F.col("days")
    return trip_nulls(spark, folder).select(
        *TRIP_IDS,
        x.clip("l_quantity", 0, 40).alias("quantity"),
        x.clip("days", 1, 180).alias("days"),
        F.month("started_at").alias("start_month"),
        x.weekday_of("started_at").alias("start_weekday"),
        x.indicator(F.col("l_quantity") > 40).alias("quantity_was_capped"),
        x.indicator(F.col("l_quantity") == 0).alias("quantity_is_zero"),
        x.indicator((days < 1) | (days > 180)).alias("days_was_adjusted"),
        "l_returnflag", "l_linestatus", "o_orderpriority",
    )


@query("log_target", """
SELECT event_id, ln(1 + value) AS log_value, exp(ln(1 + value)) - 1 AS restored FROM events
""", rounded="log_value restored")
def log_target(spark, folder):
    return events(spark, folder).select(
        "event_id", x.log_target("value").alias("log_value"),
        x.unlog_target(x.log_target("value")).alias("restored"),
    )


@query("combine_two_stage", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN greatest(value - 30, 0) ELSE 0 END AS amount FROM events
""", rounded="amount")
def combine_two_stage(spark, folder):
    return events(spark, folder).select(
        "event_id",
        x.combine_two_stage(F.col("event_type") != "error", F.col("value") - 30).alias("amount"),
    )


@query("round_columns", """
SELECT event_id, round_even(value / 8, 2) AS value_eighth, round_even(value / 3, 3) AS value_third FROM events
""")
def round_columns(spark, folder):
    parts = events(spark, folder).select(
        "event_id", (F.col("value") / 8).alias("value_eighth"), (F.col("value") / 3).alias("value_third")
    )
    return feat.round_columns(parts, {"value_eighth": 2, "value_third": 3})


@query("quality_features", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, least(greatest(coalesce(l_quantity, 1), 0.0), 40.0) AS l_quantity,
       coalesce(l_returnflag, 'Unknown') AS l_returnflag, hour(started_at) AS pickup_hour,
       isodow(started_at) - 1 AS pickup_weekday,
       CASE WHEN isodow(started_at) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN l_suppkey IN (1, 32, 38) OR l_linenumber IN (1, 32, 38) THEN 1 ELSE 0 END AS is_hub
FROM trip_nulls
""")
def quality_features(spark, folder):
    rows = trip_nulls(spark, folder).select(*TRIP_IDS, "l_quantity", "l_returnflag", "started_at")
    filled = feat.fill_constants(rows, {"l_quantity": 1.0, "l_returnflag": "Unknown"})
    timed = feat.time_features(filled, "started_at")
    return timed.withColumns({
        "l_quantity": x.clip("l_quantity", 0, 40),
        "is_hub": x.membership_flag(["l_suppkey", "l_linenumber"], [1, 32, 38]),
    }).drop("started_at")
