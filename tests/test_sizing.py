"""Skewed joins, fits that do not follow the layout, and slots under a heavy tail."""

import numpy as np
from pyspark.sql import functions as F

from ledgerline.functions.quantiles import _slot
from ledgerline.functions.sizing import lookup_join, measured
from ledgerline.operators import models as m


def test_equal_rows_of_a_hot_key_spread_over_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(4000).select(F.lit("hot").alias("k")).union(spark.range(20).selectExpr("CAST(id AS string)"))
        table = measured(spark.createDataFrame([("hot", 1), ("3", 2)], "k string, v int"))
        out = lookup_join(facts, table, ["k"], hot_rows=100)
        rows = out.withColumn("p", F.spark_partition_id()).groupBy("k", "p").agg(F.count("*").alias("n"), F.max("v").alias("v")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    hot = [r for r in rows if r["k"] == "hot"]
    assert sum(r["n"] for r in rows) == 4020 and sum(r["n"] for r in hot) == 4000
    assert {r["v"] for r in hot} == {1} and len(hot) > 3 and max(r["n"] for r in hot) < 2000


def test_a_fit_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(3 * a + b)) for i, (a, b) in enumerate(rng.normal(size=(800, 2)))]
    df = spark.createDataFrame(rows, "id long, a double, y double")
    prep = m.Preprocessing(numeric=["a"], scale=False, one_hot=False)
    scores = []
    for parts in (2, 7):
        model = m.fit_model(df.repartition(parts), prep, m.random_forest("y", trees=5, depth=5, min_leaf=1), "y")
        scores.append([r["prediction"] for r in model.transform(df).orderBy("id").collect()])
    assert scores[0] == scores[1]


def test_no_slot_of_a_heavy_tail_is_large(spark):
    values = np.sort(np.random.default_rng(6).lognormal(3, 1.5, 400_000))
    low, high = float(values[int(0.989 * len(values))]), float(values[-1])
    tail = values[values >= low]
    slot, _ = _slot(1)
    df = spark.createDataFrame([(float(v),) for v in tail], "_v double").withColumns({"_lo0": F.lit(low), "_hi0": F.lit(high)})
    sizes = [r["count"] for r in df.groupBy(slot.alias("s")).count().collect()]
    assert max(sizes) <= 0.02 * len(tail)


def test_codes_as_ordinals_indicators_and_constants(spark):
    rows = [(float(i % 7) if i % 5 else None, "abc"[i % 3], float(i % 3 * 10 + (0 if i % 5 else 100))) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, c string, y double")
    prep = m.Preprocessing(numeric=["a"], categorical=["c"], indicator=True, ordinal=True, categorical_fill={"c": "Unknown"}, scale=False, one_hot=False)
    model = m.fit_model(df, prep, m.gradient_boosting("y", trees=1, step=1.0), "y")
    scored = model.transform(df)
    assert scored.columns == ["a", "c", "y", "prediction"]
    assert scored.where(F.abs(F.col("prediction") - F.col("y")) > 1e-6).isEmpty()
    unseen = spark.createDataFrame([(1.0, "zzz", 0.0), (None, None, 0.0)], df.schema)
    assert model.transform(unseen).where("prediction IS NULL").isEmpty()
