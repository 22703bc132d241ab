import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerline.functions import sizing
from ledgerline.operators import encoders as enc
from ledgerline.operators.splits import fold_number


def test_median_indicator_only_where_training_had_nulls(spark):
    train = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (4.0, 1.0), (9.0, 2.0), (None, 2.0)], "a double, b double")
    test = spark.createDataFrame([(None, None)], "a double, b double")
    out = enc.MedianImputer(["a", "b"]).fit(train).transform(test)
    assert out.columns == ["a", "b", "a_missing"] and tuple(out.first()) == (3.0, 1.0, 1)


def test_mode_takes_the_smallest_on_a_tie(spark):
    train = spark.createDataFrame([(3, "b"), (3, "b"), (1, "a"), (1, "a"), (None, None)], "n int, s string")
    assert enc.column_modes(train, ["n", "s"]) == {"n": 1, "s": "a"}
    out = enc.ModeImputer(["n", "s"]).fit(train).transform(train.where("n IS NULL"))
    assert tuple(out.first()) == (1, "a")


def test_fractional_median_of_integers(spark):
    train = spark.createDataFrame([(1, 2), (2, 2), (None, None)], "a int, b bigint")
    out = enc.MedianImputer(["a", "b"], indicator=False).fit(train).transform(train)
    assert dict(out.dtypes) == {"a": "double", "b": "bigint"}
    assert [tuple(r) for r in out.collect()] == [(1.0, 2), (2.0, 2), (1.5, 2)]


def test_scaler_uses_population_deviation(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = enc.PopulationScaler(["a", "b"]).fit(train).transform(train)
    assert [tuple(r) for r in out.collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_fitted_values_ignore_test_rows(spark):
    train = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    a = enc.PopulationScaler(["a"]).fit(train)
    assert a.getOrDefault(a.means) == [1.5]


def test_one_hot_unknown_null_and_infrequent(spark):
    train = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), ("d",)], "c string")
    test = spark.createDataFrame([(1, "a"), (2, "c"), (3, "zzz"), (4, None)], "id int, c string")
    plain = enc.CategoryEncoder(["c"]).fit(train).one_hot_long(test, ["id"]).collect()
    assert sorted((r["id"], r["category"], r["slot"]) for r in plain) == [(1, "a", 0), (2, "c", 2)]
    rare = enc.CategoryEncoder(["c"], min_frequency=2).fit(train).one_hot_long(test, ["id"]).collect()
    assert sorted((r["id"], r["category"]) for r in rare) == [(1, "a"), (2, "infrequent"), (3, "infrequent")]
    per_row = enc.CategoryEncoder(["c"]).fit(train).one_hot_long(test, ["id"]).groupBy("id").count()
    assert per_row.agg(F.max("count")).first()[0] == 1


def test_ordinal_codes(spark):
    train = spark.createDataFrame([(v,) for v in ["b", "a", "c", "a"]], "c string")
    test = spark.createDataFrame([("a",), ("c",), ("x",), (None,)], "c string")
    got = [r["c_index"] for r in enc.OrdinalEncoder(["c"]).fit(train).transform(test).collect()]
    assert sorted(got, key=str) == sorted([0, 2, -1, None], key=str)


@pytest.fixture(scope="module")
def targets(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"id": range(400), "c": rng.choice(list("aaaaabc"), 400), "y": rng.normal(50, 9, 400)})
    pdf.loc[0, "c"] = "single"
    return pdf, spark.createDataFrame(pdf)


def brute(train, row):
    same = train[train.c == row.c]
    mean, var = train.y.mean(), train.y.var(ddof=0)
    if same.empty:
        return mean
    weight = len(same) * var / (len(same) * var + same.y.var(ddof=0))
    return weight * same.y.mean() + (1 - weight) * mean


@pytest.mark.parametrize("limit", [None, 0])
def test_crossfit_never_sees_its_own_fold(spark, targets, monkeypatch, limit):
    pdf, df = targets
    if limit is not None:  # forces the salted join
        monkeypatch.setattr(sizing, "broadcast_limit", lambda table: limit)
    folds = {r["id"]: r["f"] for r in df.select("id", fold_number(["id"], 5).alias("f")).collect()}
    pdf = pdf.assign(f=pdf.id.map(folds))
    out = enc.TargetEncoder(["c"], "y").fit_transform_crossfit(df, ["id"]).collect()
    assert len(out) == len(pdf)
    for r in out:
        row = pdf.loc[r["id"]]
        assert np.isclose(r["c_mean"], brute(pdf[pdf.f != row.f], row))


def test_target_encoder_on_test_rows(spark, targets):
    pdf, df = targets
    model = enc.TargetEncoder(["c"], "y").fit(df)
    test = spark.createDataFrame([("a",), ("new",), (None,)], "c string")
    got = {r["c"]: r["c_mean"] for r in model.transform(test).collect()}
    assert np.isclose(got["a"], brute(pdf, pdf[pdf.c == "a"].iloc[0]))
    assert np.isclose(got["new"], pdf.y.mean()) and np.isclose(got[None], pdf.y.mean())


def test_encoders_survive_saving(spark, targets, tmp_path):
    _, df = targets
    stages = [
        enc.ConstantImputer(["c"], "unknown"), enc.CategoryEncoder(["c"], 5), enc.TargetEncoder(["c"], "y"),
        enc.OrdinalEncoder(["c"]), enc.MedianImputer(["y"]), enc.PopulationScaler(["y"]),
    ]
    model = Pipeline(stages=stages).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert model.transform(df).exceptAll(loaded.transform(df)).isEmpty()


@pytest.mark.parametrize("hot_rows", [0, 100, 10**9])
def test_salted_and_broadcast_lookups_agree(spark, monkeypatch, hot_rows):
    facts = spark.range(5000).select(
        "id", F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 > 0, 1).otherwise(F.col("id")).alias("k")
    )
    table = sizing.measured(spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("t")))
    a = sizing.lookup_join(facts, table, ["k"])
    assert "BroadcastHashJoin" in a._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(sizing, "broadcast_limit", lambda table: 0)
    b = sizing.lookup_join(facts, table, ["k"], salts=8, hot_rows=hot_rows)
    assert b.columns == a.columns and b.count() == 5000
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_fact_rows_spread_over_tasks(spark, monkeypatch):
    facts = spark.range(4000).select("id", F.lit(5).cast("long").alias("k"))
    table = sizing.measured(spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("t")))
    monkeypatch.setattr(sizing, "broadcast_limit", lambda table: 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = sizing.lookup_join(facts, table, ["k"], salts=64, hot_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 4000 and max(sizes) < 2000
