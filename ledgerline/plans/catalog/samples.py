"""Splits, samples, folds, imputers and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import encoders as enc
from ledgerline.operators import features as feat
from ledgerline.operators import filters as flt
from ledgerline.operators import joins
from ledgerline.operators import splits as sp
from ledgerline.operators.models import kept
from ledgerline.plans.bindings import (
    EVENT_HASH_SQL,
    EVENTS_SPLIT_SQL,
    TRIP_HASH_SQL,
    TRIP_IDS,
    TRIP_NULLS_SQL,
    events,
    events_split,
    trip_nulls,
)
from ledgerline.plans.registry import query
from ledgerline.sources.tables import table

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query("random_split_exact", f"""
SELECT {_KEYS}, CASE WHEN row_number() OVER (ORDER BY h, {_KEYS}) <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, {TRIP_HASH_SQL} AS h, count(*) OVER () AS n FROM lineitem WHERE l_extendedprice > 0) t
""")
def random_split_exact(spark, folder):
    lines = table(spark, folder, "lineitem").where(F.col("l_extendedprice") > 0).select(*TRIP_IDS)
    return sp.random_split_exact(lines, TRIP_IDS, 0.2, 42)


@query("random_split_hash", f"WITH {EVENTS_SPLIT_SQL} SELECT event_id, split FROM events_split")
def random_split_hash(spark, folder):
    return sp.random_split_hash(events(spark, folder).select("event_id"), ["event_id"])


@query("sort_by_row_id", f"""
SELECT event_id, value FROM (SELECT *, {EVENT_HASH_SQL} AS h FROM events) t WHERE h % 10 < 2 ORDER BY event_id
""")
def sort_by_row_id(spark, folder):
    _, test = sp.sides(sp.random_split_hash(events(spark, folder), ["event_id"]))
    return sp.sort_by_row_id(test.select("event_id", "value"), ["event_id"])


@query("temporal_holdout", """
SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN 'test' ELSE 'train' END AS split FROM events
""")
def temporal_holdout(spark, folder):
    return sp.temporal_holdout(events(spark, folder).select("event_id", "ts"), "ts", "2024-01-24").drop("ts")


@query("temporal_split_sample", f"""
WITH marked AS (
  SELECT event_id, {EVENT_HASH_SQL} AS h, CASE WHEN ts >= TIMESTAMP '2024-01-24' THEN 'test' ELSE 'train' END AS split
  FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY h, event_id) AS r,
                  count(*) OVER (PARTITION BY split) AS pool FROM marked),
sizes AS (SELECT least(4000, max(pool) FILTER (WHERE split = 'train')) AS train_n,
                 max(pool) FILTER (WHERE split = 'test') AS test_pool FROM ranked)
SELECT event_id, split FROM ranked, sizes
WHERE (split = 'train' AND r <= train_n) OR (split = 'test' AND r <= least(5000 - train_n, test_pool))
""")
def temporal_split_sample(spark, folder):
    rows = events(spark, folder).select("event_id", "ts")
    return sp.temporal_split_sample(rows, "ts", "2024-01-24", 5000, ["event_id"]).drop("ts")


@query("fixed_sample", f"""
SELECT {_KEYS} FROM (SELECT *, row_number() OVER (ORDER BY {TRIP_HASH_SQL}, {_KEYS}) AS r FROM lineitem) t WHERE r <= 10000
""")
def fixed_sample(spark, folder):
    return sp.fixed_sample(table(spark, folder, "lineitem").select(*TRIP_IDS), 10_000, TRIP_IDS)


@query("kfold_assign", f"SELECT event_id, {EVENT_HASH_SQL} % 5 AS fold FROM events")
def kfold_assign(spark, folder):
    return sp.kfold_assign(events(spark, folder).select("event_id"), ["event_id"], 5)


@query("train_only_filter", f"""
WITH {EVENTS_SPLIT_SQL}
SELECT event_id, split, value FROM events_split WHERE split = 'test' OR (value > 1 AND value <= 200)
""")
def train_only_filter(spark, folder):
    condition = (F.col("value") > 1) & (F.col("value") <= 200)
    return flt.train_only_filter(events_split(spark, folder), "split", condition).select("event_id", "split", "value")


@query("scatter_sample", f"""
SELECT event_id, user_id, value FROM (
  SELECT *, row_number() OVER (ORDER BY {EVENT_HASH_SQL}, event_id) AS r FROM events) t
WHERE r <= 3000 AND value <= 150
""")
def scatter_sample(spark, folder):
    sample = sp.fixed_sample(events(spark, folder).select("event_id", "user_id", "value"), 3000, ["event_id"])
    return sample.where(F.col("value") <= 150)


# Imputers and encoders: fitted on the training side of the trip or event split ----------

_TRIP_SPLIT_SQL = TRIP_NULLS_SQL + f""", trip_split AS (
  SELECT *, CASE WHEN {TRIP_HASH_SQL} % 10 < 2 THEN 'test' ELSE 'train' END AS split FROM trip_nulls)"""


def trip_split(spark, folder):
    return sp.random_split_hash(trip_nulls(spark, folder), TRIP_IDS)


@query("impute_constant", f"""
WITH {TRIP_NULLS_SQL}
SELECT {_KEYS}, coalesce(l_quantity, 0) AS l_quantity, coalesce(l_tax, 0) AS l_tax,
       coalesce(l_returnflag, 'unknown') AS l_returnflag, coalesce(CAST(l_linenumber AS VARCHAR), 'unknown') AS line_text
FROM trip_nulls
""")
def impute_constant(spark, folder):
    rows = trip_nulls(spark, folder).select(
        *TRIP_IDS, "l_quantity", "l_tax", "l_returnflag", F.col("l_linenumber").alias("line_text")
    )
    numbers = enc.ConstantImputer(["l_quantity", "l_tax"], 0).transform(rows)
    return enc.ConstantImputer(["l_returnflag", "line_text"], "unknown").transform(numbers)


@query("impute_median_indicator", f"""
WITH {_TRIP_SPLIT_SQL}
SELECT {_KEYS}, split,
       coalesce(l_quantity, (SELECT quantile_cont(l_quantity, 0.5) FROM trip_split WHERE split = 'train')) AS l_quantity,
       coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM trip_split WHERE split = 'train')) AS l_tax,
       CASE WHEN l_quantity IS NULL THEN 1 ELSE 0 END AS l_quantity_missing,
       CASE WHEN l_tax IS NULL THEN 1 ELSE 0 END AS l_tax_missing, l_discount
FROM trip_split
""")
def impute_median_indicator(spark, folder):
    rows = trip_split(spark, folder).select(*TRIP_IDS, "split", "l_quantity", "l_tax", "l_discount")
    imputer = enc.MedianImputer(["l_quantity", "l_tax", "l_discount"])
    with kept(rows.where(F.col("split") == "train").select(*imputer.columns())) as train:
        fitted = imputer.fit(train)
    return fitted.transform(rows)


@query("impute_mode", f"""
WITH {_TRIP_SPLIT_SQL},
flags AS (SELECT l_returnflag AS v FROM trip_split WHERE split = 'train' AND l_returnflag IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
amounts AS (SELECT l_quantity AS v FROM trip_split WHERE split = 'train' AND l_quantity IS NOT NULL
          GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT {_KEYS}, coalesce(l_returnflag, (SELECT v FROM flags)) AS l_returnflag,
       coalesce(l_quantity, (SELECT v FROM amounts)) AS l_quantity FROM trip_split
""")
def impute_mode(spark, folder):
    rows = trip_split(spark, folder).select(*TRIP_IDS, "split", "l_returnflag", "l_quantity")
    fitted = enc.ModeImputer(["l_returnflag", "l_quantity"]).fit(rows.where(F.col("split") == "train"))
    return fitted.transform(rows).drop("split")


@query("standard_scale", f"""
WITH {_TRIP_SPLIT_SQL},
fitted AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s, avg(days) AS md, stddev_pop(days) AS sd
           FROM trip_split WHERE split = 'train')
SELECT {_KEYS}, (l_extendedprice - m) / s AS l_extendedprice, (days - md) / sd AS days FROM trip_split, fitted
""", rounded="l_extendedprice days")
def standard_scale(spark, folder):
    rows = trip_split(spark, folder).select(*TRIP_IDS, "split", "l_extendedprice", "days")
    fitted = enc.PopulationScaler(["l_extendedprice", "days"]).fit(rows.where(F.col("split") == "train"))
    return fitted.transform(rows).drop("split")


# The category 'error' is unknown: it occurs on the test side only.
_CATEGORY_SQL = EVENTS_SPLIT_SQL + """, train AS (
  SELECT * FROM events_split WHERE split = 'train' AND event_type <> 'error')"""


def _category_sides(spark, folder):
    rows = events_split(spark, folder)
    return rows, rows.where((F.col("split") == "train") & (F.col("event_type") != "error"))


# Keys of user, type and time of day: some rare, some on the test side only.
_KEYED_SQL = EVENTS_SPLIT_SQL + """, keyed AS (
  SELECT *, user_id || '_' || event_type AS route_id, user_id || '_' || event_type || '_' ||
         CASE WHEN hour(ts) <= 5 THEN 'night' WHEN hour(ts) <= 9 THEN 'morning_peak'
              WHEN hour(ts) <= 15 THEN 'daytime' WHEN hour(ts) <= 19 THEN 'evening_peak'
              ELSE 'late_evening' END AS route_period_id
  FROM events_split), train AS (SELECT * FROM keyed WHERE split = 'train')"""


def _keyed_sides(spark, folder):
    rows = feat.route_features(events_split(spark, folder), "user_id", "event_type", "ts")
    return rows, rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


@query("one_hot", f"""
WITH {_CATEGORY_SQL},
vocabulary AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS slot FROM train GROUP BY event_type)
SELECT event_id, 'event_type' AS "column", e.event_type AS category, slot
FROM events_split e JOIN vocabulary v ON e.event_type = v.event_type
""")
def one_hot(spark, folder):
    rows, train = _category_sides(spark, folder)
    return enc.CategoryEncoder(["event_type"]).fit(train).one_hot_long(rows, ["event_id"])


@query("one_hot_drop_first", f"""
WITH {_CATEGORY_SQL},
vocabulary AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS slot FROM train GROUP BY event_type)
SELECT event_id, 'event_type' AS "column", e.event_type AS category, slot
FROM events_split e JOIN vocabulary v ON e.event_type = v.event_type WHERE slot > 0
""")
def one_hot_drop_first(spark, folder):
    rows, train = _category_sides(spark, folder)
    return enc.CategoryEncoder(["event_type"]).fit(train).one_hot_long(rows, ["event_id"], drop_first=True)


@query("one_hot_infrequent", f"""
WITH {_KEYED_SQL},
counts AS (SELECT route_id, count(*) AS n FROM train GROUP BY 1),
mapped AS (SELECT event_id, CASE WHEN n >= 10 THEN e.route_id ELSE 'infrequent' END AS category
           FROM keyed e LEFT JOIN counts c ON e.route_id = c.route_id),
vocabulary AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS slot FROM (
  SELECT DISTINCT CASE WHEN n >= 10 THEN route_id ELSE 'infrequent' END AS category FROM counts) d)
SELECT event_id, 'route_id' AS "column", m.category, slot FROM mapped m JOIN vocabulary v ON m.category = v.category
""")
def one_hot_infrequent(spark, folder):
    rows, train, _ = _keyed_sides(spark, folder)
    return enc.CategoryEncoder(["route_id"], min_frequency=10).fit(train).one_hot_long(rows, ["event_id"])


@query("ordinal_encode", f"""
WITH {_CATEGORY_SQL},
vocabulary AS (SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS i FROM train GROUP BY event_type)
SELECT event_id, coalesce(i, -1) AS event_type_index FROM events_split e LEFT JOIN vocabulary v USING (event_type)
""")
def ordinal_encode(spark, folder):
    rows, train = _category_sides(spark, folder)
    return enc.OrdinalEncoder(["event_type"]).fit(train).transform(rows).select("event_id", "event_type_index")


def _shrink(n, mean, var, global_mean, global_var):
    weight = f"({n} * {global_var} / nullif({n} * {global_var} + {var}, 0))"
    return f"CASE WHEN {n} > 0 THEN coalesce({weight}, 1) * {mean} + (1 - coalesce({weight}, 1)) * {global_mean} ELSE {global_mean} END"


@query("target_encode", f"""
WITH {_KEYED_SQL},
g AS (SELECT avg(value) AS gm, var_pop(value) AS gv FROM train),
c AS (SELECT route_period_id, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM train GROUP BY 1)
SELECT event_id, coalesce({_shrink('n', 'm', 'v', 'gm', 'gv')}, gm) AS route_period_id_mean
FROM keyed e CROSS JOIN g LEFT JOIN c ON e.route_period_id = c.route_period_id WHERE split = 'test'
""", rounded="route_period_id_mean")
def target_encode(spark, folder):
    _, train, test = _keyed_sides(spark, folder)
    fitted = enc.TargetEncoder(["route_period_id"], "value").fit(train)
    return fitted.transform(test).select("event_id", "route_period_id_mean")


@query("target_encode_crossfit", f"""
WITH hashed AS (SELECT event_id, user_id, value, {EVENT_HASH_SQL} % 5 AS fold FROM events),
folds AS (SELECT DISTINCT fold FROM hashed),
g AS (SELECT f.fold, avg(value) AS gm, var_pop(value) AS gv FROM folds f JOIN hashed h ON h.fold <> f.fold GROUP BY 1),
c AS (SELECT f.fold, user_id, count(*) AS n, avg(value) AS m, var_pop(value) AS v
      FROM folds f JOIN hashed h ON h.fold <> f.fold GROUP BY 1, 2)
SELECT event_id, CASE WHEN n IS NULL THEN gm ELSE {_shrink('n', 'm', 'v', 'gm', 'gv')} END AS user_id_mean
FROM hashed h JOIN g ON h.fold = g.fold LEFT JOIN c ON c.fold = h.fold AND c.user_id = h.user_id
""", rounded="user_id_mean")
def target_encode_crossfit(spark, folder):
    rows = events(spark, folder).select("event_id", "user_id", "value")
    encoder = enc.TargetEncoder(["user_id"], "value")
    return encoder.fit_transform_crossfit(rows, ["event_id"]).select("event_id", "user_id_mean")


@query("apply_group_stats", f"""
WITH {_KEYED_SQL}
SELECT event_id, coalesce(m, (SELECT avg(value) FROM train)) AS prediction
FROM keyed e LEFT JOIN (SELECT route_period_id, avg(value) AS m FROM train GROUP BY 1) s
  ON e.route_period_id = s.route_period_id
WHERE split = 'test'
""", rounded="prediction")
def apply_group_stats(spark, folder):
    _, train, test = _keyed_sides(spark, folder)
    scored = joins.apply_group_stats(train, test, "route_period_id", {"prediction": "value"})
    return scored.select("event_id", "prediction")
