"""Vector-target trees against group means, a plain recursive tree, and themselves grown two ways."""

import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerline.operators import models as m
from ledgerline.operators import trees as t


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    n = 900
    pdf = pd.DataFrame({"id": range(n), "a": rng.integers(0, 40, n).astype(float), "b": rng.integers(0, 25, n).astype(float), "c": rng.choice(list("pqrst"), n)})
    pdf["y"] = np.where(pdf.a > 20, 5.0, 0.0) + pdf.b / 7 + rng.normal(0, 0.3, n)
    pdf["z"] = np.where(pdf.b > 12, -3.0, 1.0) * pdf.c.map(ord) / 100
    df = spark.createDataFrame(pdf).repartition(6)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).select("id", "features", "y", "z")
    return pdf, df, vectors


def plain_tree(x, y, depth, min_leaf, least):
    """Recursive best splits over all cuts, in plain Python."""
    best = (least, None, None)
    if depth:
        whole = (y.sum(axis=0) ** 2).sum() / len(y)
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= cut
                if min(left.sum(), (~left).sum()) >= min_leaf:
                    gain = sum((y[s].sum(axis=0) ** 2).sum() / s.sum() for s in (left, ~left)) - whole
                    if gain > best[0] * (1 + 1e-9):
                        best = (gain, f, cut)
    if best[1] is None:
        mean = y.mean(axis=0)
        return lambda row: mean
    left = x[:, best[1]] <= best[2]
    below, above = (plain_tree(x[s], y[s], depth - 1, min_leaf, least) for s in (left, ~left))
    return lambda row: below(row) if row[best[1]] <= best[2] else above(row)


def predicted(model, vectors):
    got = model.transform(vectors).orderBy("id").collect()
    return np.array([[r["y_prediction"], r["z_prediction"]] for r in got])


@pytest.mark.parametrize("local_rows", [1 << 16, 200, 1])
def test_one_tree_equals_plain_recursion(rows, local_rows):
    pdf, _, vectors = rows
    model = t.fit_vector_forest(vectors, "features", ["y", "z"], 1, 5, 10, draw=False, local_rows=local_rows)
    x, y = pdf[["a", "b"]].to_numpy(), pdf[["y", "z"]].to_numpy()
    centred = y - y.mean(axis=0)
    tree = plain_tree(x, centred, 5, 10, t.LEAST_GAIN * (centred ** 2).sum())
    assert np.allclose(predicted(model, vectors), np.array([tree(row) for row in x]) + y.mean(axis=0))


def test_forest_does_not_depend_on_where_trees_are_grown(rows):
    _, _, vectors = rows
    few, many = (t.fit_vector_forest(vectors, "features", ["y", "z"], 7, 6, 3, local_rows=k) for k in (1, 1 << 16))
    assert np.allclose(predicted(few, vectors), predicted(many, vectors))


def test_one_tree_on_one_code_is_the_group_means_of_all_targets(rows):
    pdf, df, _ = rows
    prep = m.Preprocessing(categorical=["c"], scale=False, one_hot=False)
    model = m.fit_forest_multi(df, prep, ["y", "z"], trees=1, depth=5, min_leaf=1, draw=False)
    got = model.transform(df).orderBy("id").toPandas()
    for target in ("y", "z"):
        assert np.allclose(got[f"{target}_prediction"], pdf.groupby("c")[target].transform("mean"))
    assert list(got.columns) == [*df.columns, "y_prediction", "z_prediction"]


def test_draws_have_the_right_mean_and_differ_by_tree():
    keys = np.arange(100_000, dtype=np.uint64)
    a, b = t.drawn(keys, 0, 42), t.drawn(keys, 1, 42)
    assert abs(a.mean() - 1) < 0.02 and abs(a.var() - 1) < 0.03 and abs(np.corrcoef(a, b)[0, 1]) < 0.02


def test_many_groups_of_trees_and_saving(rows, tmp_path, monkeypatch):
    _, df, _ = rows
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c"], scale=False, one_hot=False)
    model = m.fit_forest_multi(df, prep, ["y", "z"], trees=9, depth=6, min_leaf=5)
    before = predicted(model, df)
    model.write().save(str(tmp_path / "forest"))
    monkeypatch.setattr(t, "SENT_BYTES", 10_000)
    assert np.allclose(predicted(PipelineModel.load(str(tmp_path / "forest")), df), before)
    assert np.corrcoef(before[:, 0], df.orderBy("id").toPandas()["y"])[0, 1] > 0.95


def test_rows_with_an_unknown_target_are_left_out(rows):
    _, df, _ = rows
    prep = m.Preprocessing(numeric=["a"], categorical=["c"], scale=False, one_hot=False)
    partly = df.withColumn("y", F.when(F.col("id") % 2 == 0, F.col("y")))
    a = m.fit_forest_multi(partly, prep, ["y", "z"], trees=1, depth=4, min_leaf=5, draw=False)
    b = m.fit_forest_multi(df.where("id % 2 = 0"), prep, ["y", "z"], trees=1, depth=4, min_leaf=5, draw=False)
    assert np.allclose(predicted(a, df), predicted(b, df))
    with pytest.raises(ValueError):
        m.fit_forest_multi(df.withColumn("y", F.lit(None).cast("double")), prep, ["y", "z"], trees=1)


def test_grafting_keeps_the_answers():
    rng = np.random.default_rng(0)
    bins, y = rng.integers(0, 30, (400, 3)).astype(np.uint16), rng.normal(size=(400, 2))
    whole = t.grown(bins, y, np.ones(400), 6, 2, 0.0).arrays()
    top = t.grown(bins, y, np.ones(400), 2, 2, 0.0).arrays()
    at = t.landed(bins, top)
    parts = {int(n): t.grown(bins[at == n], y[at == n], np.ones((at == n).sum()), 4, 2, 0.0).arrays() for n in np.unique(at)}
    joined = pickle.loads(pickle.dumps(t.grafted(top, parts)))
    assert np.allclose(whole[4][t.landed(bins, whole)], joined[4][t.landed(bins, joined)])


@pytest.mark.parametrize("min_leaf", [1, 7])
def test_sums_per_bin_and_sorted_rows_give_the_same_tree(monkeypatch, min_leaf):
    rng = np.random.default_rng(1)
    bins, y = rng.integers(0, 200, (3000, 3)).astype(np.uint8), rng.normal(size=(3000, 2))
    weights = t.drawn(np.arange(3000, dtype=np.uint64), 0, 1)
    made = []
    for cells in (0, 1 << 20):
        monkeypatch.setattr(t, "CELLS", cells)
        made.append(t.grown(bins, y, weights, 9, min_leaf, 1e-9).arrays())
    assert len(made[0][0]) > 100
    for a, b in zip(*made):
        assert np.allclose(a, b)


def test_rows_of_a_task_become_few_blocks(spark):
    rows = spark.range(0, 30_000, 1, 1).selectExpr("cast(id % 7 AS double) AS a", "cast(id AS double) AS y")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows)
    blocks = t.blocks_of(vectors, "features", ["y"], [np.arange(6) + 0.5])
    assert [r["size"] for r in blocks.collect()] == [30_000]
    blocks.unpersist()
