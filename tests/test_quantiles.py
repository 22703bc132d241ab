import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions import quantiles
from ledgerline.functions.prefix import running_total
from ledgerline.functions.quantiles import column_quantiles, median_value, quantile_table, quantile_values

PROBS = [0.0, 0.01, 0.25, 0.5, 0.5, 0.75, 0.995, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    n = 30_000
    # One key holds most rows; values are continuous, repeated, constant or extreme.
    key = rng.choice(["hot", "cold", "flat"], n, p=[0.7, 0.25, 0.05])
    value = np.where(key == "hot", rng.lognormal(3, 2, n), np.where(key == "cold", rng.integers(0, 7, n), 4.25))
    value[::5000] = 1e9
    pdf = pd.DataFrame({"k": key, "v": value})
    pdf.loc[::97, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf).repartition(13)


@pytest.mark.parametrize("small_group", [0, 10**9])
def test_groups_match_numpy(frame, small_group):
    pdf, df = frame
    rows = {r["k"]: r for r in quantile_table(df, "v", PROBS, ["k"], small_group).collect()}
    for key, group in pdf.dropna().groupby("k"):
        expected = group["v"].quantile(PROBS).tolist()
        got = [rows[key][f"q{i}"] for i in range(len(PROBS))]
        assert rows[key]["n"] == len(group)
        assert np.allclose(got, expected, rtol=1e-12, atol=0)


def test_many_groups_with_a_few_large_ones(frame, monkeypatch):
    pdf, df = frame
    monkeypatch.setattr(quantiles, "fits_broadcast", lambda table: False)
    rows = {r["k"]: r for r in quantile_table(df, "v", [0.1, 0.5], ["k"], 8000).collect()}
    assert len(rows) == 3
    for key, group in pdf.dropna().groupby("k"):
        assert np.allclose([rows[key]["q0"], rows[key]["q1"]], group["v"].quantile([0.1, 0.5]).tolist(), rtol=1e-12)


@pytest.mark.parametrize("small_group", [0, 10**9])
def test_whole_column_and_edges(spark, frame, small_group):
    pdf, df = frame
    row = quantile_table(df, "v", PROBS, (), small_group).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(PROBS))], pdf["v"].quantile(PROBS).tolist(), rtol=1e-12)
    four = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "v double")
    assert quantile_table(four, "v", [0.5], (), small_group).first()["q0"] == 3.0
    single = spark.createDataFrame([(7.0,)], "v double")
    assert quantile_table(single, "v", [0.0, 0.3, 1.0], (), small_group).first()[1:] == (7.0, 7.0, 7.0)


def test_empty_and_null_keys(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert median_value(empty, "v") is None and quantile_values(empty, "v", [0.1, 0.9]) == [None, None]
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "k string, v double")
    for small in (0, 10):
        got = {r["k"]: r["q0"] for r in quantile_table(df, "v", [0.5], ["k"], small).collect()}
        assert got == {None: 2.0, "a": 5.0}
    with pytest.raises(ValueError):
        quantile_table(df, "v", [0.5, 0.1])


def test_columns_together(spark, frame):
    pdf, df = frame
    wide = df.withColumn("w", F.col("v") * 2)
    got = {r["column"]: r["q0"] for r in column_quantiles(wide, ["v", "w"], [0.5]).collect()}
    assert np.isclose(got["w"], 2 * got["v"])


@pytest.mark.parametrize("small_table", [0, 10**6])
def test_running_total(spark, small_table):
    df = spark.range(1000).select(F.col("id").alias("v"), (F.col("id") % 3).alias("n")).repartition(7)
    got = running_total(df, ["v"], "n", "upto", small_table).orderBy("v").collect()
    assert [r["upto"] for r in got] == np.cumsum([i % 3 for i in range(1000)]).tolist()
