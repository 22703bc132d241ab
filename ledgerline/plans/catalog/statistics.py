"""Describe, correlation, rank correlation and two-group tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import filters as flt
from ledgerline.operators import joins
from ledgerline.operators import statistics as st
from ledgerline.plans.bindings import TRIP_NULLS_SQL, TRIP_SQL, events, trip, trip_nulls
from ledgerline.plans.registry import query
from ledgerline.sources.tables import table

DESCRIBED = ["l_quantity", "l_extendedprice", "l_tax", "days", "amount"]


@query("describe_table", f"WITH {TRIP_NULLS_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    f"min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, "
    f"quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM trip_nulls" for c in DESCRIBED
), rounded="mean std min q25 q50 q75 max", digits=5)
def describe_table(spark, folder):
    return st.describe_table(trip_nulls(spark, folder), DESCRIBED)


CORRELATED = ["l_quantity", "l_extendedprice", "l_tax", "days"]


def _pairs_sql() -> str:
    parts = []
    for a in CORRELATED:
        for b in CORRELATED:
            r = f"CASE WHEN var_pop({a}) > 0 THEN 1.0::DOUBLE END" if a == b else f"corr({a}, {b})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r} AS r FROM trip_nulls")
    return f"WITH {TRIP_NULLS_SQL} " + " UNION ALL ".join(parts)


@query("correlation_matrix", _pairs_sql(), rounded="r")
def correlation_matrix(spark, folder):
    return st.correlation_matrix(trip_nulls(spark, folder), CORRELATED)


@query("correlation_pair", f"""
WITH {TRIP_NULLS_SQL}
SELECT count(*) FILTER (WHERE l_quantity IS NOT NULL AND amount IS NOT NULL) AS row_count,
       corr(l_quantity, amount) AS r, corr(least(greatest(l_quantity, 0.0), 40.0), amount) FILTER (WHERE l_quantity IS NOT NULL) AS r_clipped
FROM trip_nulls
""", rounded="r r_clipped")
def correlation_pair(spark, folder):
    return st.correlation_pair(trip_nulls(spark, folder), "l_quantity", "amount", x.clip("l_quantity", 0, 40))


@query("target_correlations", f"WITH {TRIP_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", corr({c}, amount) AS r FROM trip" for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "days"]
), rounded="r")
def target_correlations(spark, folder):
    return st.target_correlations(
        trip(spark, folder), "amount", ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "days"]
    )


@query("average_rank", """
SELECT value, count(*) AS copies,
       sum(count(*)) OVER (ORDER BY value) - (count(*) - 1) / 2.0 AS rank
FROM events GROUP BY value
""", rounded="rank")
def average_rank(spark, folder):
    return st.average_rank(events(spark, folder), "value")


@query("spearman", """
WITH pairs AS (SELECT l_quantity AS a, l_extendedprice AS b FROM lineitem),
ranked AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
                  rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM pairs)
SELECT count(*) AS row_count, corr(ra, rb) AS rho FROM ranked
""", rounded="rho", digits=8)
def spearman(spark, folder):
    return st.spearman(table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice")


_WELCH_SQL = """
WITH m AS (
  SELECT count(*) FILTER (WHERE event_type = 'click') AS na, count(*) FILTER (WHERE event_type = 'view') AS nb,
         avg(value) FILTER (WHERE event_type = 'click') AS ma, avg(value) FILTER (WHERE event_type = 'view') AS mb,
         var_samp(value) FILTER (WHERE event_type = 'click') AS va, var_samp(value) FILTER (WHERE event_type = 'view') AS vb
  FROM events)
"""


@query("welch_ttest", _WELCH_SQL + """
SELECT 'click' AS group_1, 'view' AS group_2, na AS group_1_rows, nb AS group_2_rows,
       ma AS group_1_mean, mb AS group_2_mean, (ma - mb) / sqrt(va / na + vb / nb) AS t_statistic,
       (va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)) AS degrees_of_freedom,
       (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) AS cohens_d
FROM m
""", rounded="group_1_mean group_2_mean t_statistic degrees_of_freedom cohens_d")
def welch_ttest(spark, folder):
    return st.welch_ttest(
        events(spark, folder), "value", F.col("event_type") == "click", F.col("event_type") == "view",
        "click", "view", p_value=False,
    )


@query("cohens_d", _WELCH_SQL + """
SELECT 'click' AS group_1, 'view' AS group_2,
       (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) AS cohens_d FROM m
""", rounded="cohens_d", digits=9)
def cohens_d(spark, folder):
    return welch_ttest(spark, folder).select("group_1", "group_2", "cohens_d")


@query("significance_flag", _WELCH_SQL + """
SELECT 'click' AS group_1, 'view' AS group_2, abs((ma - mb) / sqrt(va / na + vb / nb)) > 1.9605 AS significant FROM m
""")
def significance_flag(spark, folder):
    # About 4,000 degrees of freedom and more: p < 0.05 is |t| above 1.9605.
    return st.welch_ttest(
        events(spark, folder), "value", F.col("event_type") == "click", F.col("event_type") == "view",
        "click", "view",
    ).select("group_1", "group_2", "significant")


# The tail of t with x = sqrt(df) tan(angle): Simpson's rule on 20,000 strips of the angle.
@query("welch_p_value", """
WITH m AS (
  SELECT count(value) FILTER (WHERE NOT weekend) AS na, count(value) FILTER (WHERE weekend) AS nb,
         avg(value) FILTER (WHERE NOT weekend) AS ma, avg(value) FILTER (WHERE weekend) AS mb,
         var_samp(value) FILTER (WHERE NOT weekend) AS va, var_samp(value) FILTER (WHERE weekend) AS vb
  FROM (SELECT value, isodow(ts) >= 6 AS weekend FROM events)),
test AS (
  SELECT 'weekday' AS group_1, 'weekend' AS group_2, na AS group_1_rows, nb AS group_2_rows, ma AS group_1_mean, mb AS group_2_mean,
         (ma - mb) / sqrt(va / na + vb / nb) AS t_statistic,
         (va / na + vb / nb) ** 2 / ((va / na) ** 2 / (na - 1) + (vb / nb) ** 2 / (nb - 1)) AS degrees_of_freedom,
         (ma - mb) / sqrt(((na - 1) * va + (nb - 1) * vb) / (na + nb - 2)) AS cohens_d FROM m),
strips AS (
  SELECT test.*, atan(abs(t_statistic) / sqrt(degrees_of_freedom)) AS low, (pi() / 2 - low) / 20000 AS width, i,
         CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight
  FROM test, range(20001) r(i)),
tail AS (
  SELECT 2 * any_value(width) / 3 * exp(any_value(lgamma((degrees_of_freedom + 1) / 2) - lgamma(degrees_of_freedom / 2) - ln(pi()) / 2))
         * sum(weight * greatest(cos(low + i * width), 0) ** (degrees_of_freedom - 1)) AS p_value FROM strips)
SELECT test.*, p_value, p_value < 0.05 AS significant FROM test, tail
""", rounded="group_1_mean group_2_mean t_statistic degrees_of_freedom cohens_d p_value", digits=6)
def welch_p_value(spark, folder):
    weekend = F.weekday("ts") >= 5
    return st.welch_ttest(events(spark, folder), "value", ~weekend, weekend, "weekday", "weekend")


@query("scalar_broadcast", "SELECT event_id, value FROM events WHERE value > (SELECT avg(value) FROM events)")
def scalar_broadcast(spark, folder):
    return joins.above_mean(events(spark, folder).select("event_id", "value"), "value")


@query("sentinel_describe", """
WITH filled AS (SELECT CASE WHEN event_id % 7 = 0 THEN -1 ELSE value END AS value FROM events),
masked AS (SELECT CASE WHEN value = -1 THEN NULL ELSE value END AS value FROM filled)
SELECT 'value' AS "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75,
       max(value) AS max FROM masked
""", rounded="mean std q25 q50 q75")
def sentinel_describe(spark, folder):
    filled = events(spark, folder).select(
        F.when(F.col("event_id") % 7 == 0, -1.0).otherwise(F.col("value")).alias("value")
    )
    return st.describe_table(filled.select(F.nullif("value", F.lit(-1.0)).alias("value")), ["value"])


@query("positive_band_correlation", f"""
WITH {TRIP_SQL}, kept AS (SELECT l_quantity, amount FROM trip WHERE days > 0 AND days <= (
  SELECT quantile_cont(days, 0.99) FROM trip WHERE days > 0))
SELECT count(*) AS row_count, corr(l_quantity, amount) AS r FROM kept
""", rounded="r")
def positive_band_correlation(spark, folder):
    positive = trip(spark, folder).where(F.col("days") > 0)
    return st.correlation_pair(flt.trim_quantile_band(positive, "days", None, 0.99), "l_quantity", "amount")
