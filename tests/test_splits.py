import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from ledgerline.operators import splits as sp


@pytest.fixture(scope="module")
def population(spark):
    return spark.range(997).select(F.col("id"), (F.col("id") % 7).alias("v")).cache()


def test_exact_split_partitions_the_rows(population):
    split = sp.random_split_exact(population, ["id"], 0.2, 42)
    train, test = sp.sides(split)
    assert test.count() == math.ceil(0.2 * 997)
    assert train.unionAll(test).exceptAll(population).isEmpty() and train.count() + test.count() == 997
    assert train.join(test, "id").isEmpty()


def test_split_does_not_depend_on_layout(population):
    a = sp.random_split_exact(population, ["id"])
    b = sp.random_split_exact(population.repartition(11, "v"), ["id"])
    assert a.exceptAll(b).isEmpty()
    assert not sp.random_split_exact(population, ["id"], seed=7).exceptAll(a).isEmpty()


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hs.integers(min_value=0, max_value=1100))
def test_first_by_hash_takes_exactly_n(population, n):
    assert population.where(sp.first_by_hash(population, ["id"], n, 42)).count() == min(n, 997)


def test_samples_are_nested(population):
    small, large = sp.fixed_sample(population, 50, ["id"]), sp.fixed_sample(population, 400, ["id"])
    assert small.join(large, "id", "left_anti").isEmpty()


def test_folds_cover_each_row_once(population):
    folded = sp.kfold_assign(population, ["id"], 5)
    counts = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}
    assert sorted(counts) == [0, 1, 2, 3, 4] and sum(counts.values()) == 997


def test_temporal_holdout_and_sample(spark):
    df = spark.range(240).select("id", F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,CAST(id AS INT))").alias("ts"))
    with pytest.raises(ValueError):
        sp.temporal_holdout(df, "ts", "2030-01-01")
    with pytest.raises(ValueError):
        sp.temporal_split_sample(df, "ts", "2024-01-08", 9, ["id"])
    sample = sp.temporal_split_sample(df, "ts", "2024-01-08", 100, ["id"])
    counts = {r["split"]: r["count"] for r in sample.groupBy("split").count().collect()}
    assert counts == {"train": 80, "test": 20}
    everything = sp.temporal_split_sample(df, "ts", "2024-01-08", 10_000, ["id"])
    assert everything.count() == 240
