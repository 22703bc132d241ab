"""Digests by key range, exact areas, and blocked co-moments against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import evaluation as ev
from ledgerline.operators import quality as q
from ledgerline.operators import statistics as st


def test_one_changed_row_is_found_in_one_range(spark):
    left = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    right = left.repartition(5).withColumn("v", F.when(F.col("k") == 777, -1).otherwise(F.col("v")))
    edges = q.key_edges(left, "k", 64)
    assert len(q.differing_ranges(left, right, "k", edges)) == 1 and len(edges) > 50
    assert q.differing_ranges(left, left.repartition(3), "k", edges) == []
    got = {tuple(r) for r in q.reconcile_ranges(left, right, "k", 64).collect()}
    assert got == {(777, 2331, 1), (777, -1, -1)}


def test_copies_nulls_and_missing_ranges(spark):
    rows = [(1, "a")] * 3 + [(None, "n"), (5, "x"), (900, None)]
    left = spark.createDataFrame(rows, "k int, v string")
    right = spark.createDataFrame([(1, "a")] * 2 + [(5, "x"), (-7, "new")], "k int, v string")
    got = {tuple(r) for r in q.reconcile_ranges(left, right, "k", 4).collect()}
    assert got == {tuple(r) for r in q.row_differences(left, right).collect()}
    assert got == {(1, "a", 1), (None, "n", 1), (900, None, 1), (-7, "new", -1)}
    empty = left.limit(0)
    assert q.reconcile_ranges(empty, empty, "k").collect() == []
    assert q.reconcile_ranges(empty, left, "k").count() == q.row_differences(empty, left).count()


def test_only_differing_ranges_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10_000).select(F.col("id").alias("k"), F.col("id").alias("v")).write.parquet(path)
    table = spark.read.parquet(path)
    edges = q.key_edges(table, "k", 16)
    plan = table.where(q.in_ranges("k", edges, [3, 4]))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(k," in plan and "LessThanOrEqual(k," in plan


def test_area_equals_all_pairs(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"label": rng.integers(0, 2, 500), "score": rng.integers(0, 40, 500) / 7.0})
    pdf["score"] += pdf.label * 0.8
    df = spark.createDataFrame(pdf)
    up, down = pdf.score[pdf.label == 1].to_numpy()[:, None], pdf.score[pdf.label == 0].to_numpy()
    assert ev.roc_auc(df, "label", "score").first()["roc_auc"] == pytest.approx(((up > down) + 0.5 * (up == down)).mean(), abs=1e-12)
    curve = ev.roc_curve(df, "label", "score").orderBy("score").collect()
    assert len(curve) == pdf.score.nunique() and curve[0]["true_positive_rate"] == curve[0]["false_positive_rate"] == 1
    cut = curve[20]["score"]
    assert curve[20]["true_positive_rate"] == pytest.approx((up >= cut).mean())
    assert ev.roc_auc(df.where("label = 1"), "label", "score").first()["roc_auc"] is None


def test_three_hundred_columns_with_nulls(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 300)) + rng.normal(size=(400, 1)) + 1e6
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 5.0
    x[:, 9] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(300)])
    df = spark.createDataFrame(pdf).replace(float("nan"), None).repartition(4)
    got = st.correlation_matrix(df, list(pdf.columns)).toPandas()
    assert len(got) == 300 * 300
    want = pdf.corr()
    r = got.set_index(["col_a", "col_b"])["r"].unstack().loc[want.index, want.columns].astype(float)
    assert np.allclose(r.fillna(9), want.fillna(9), atol=1e-8)
    assert r.loc["c7"].isna().all() and r.loc["c9"].isna().all()
