"""Softmax boosting against closed forms and a plain version."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerline.operators import models as m
from ledgerline.operators import softmax as s


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(8)
    n = 1200
    pdf = pd.DataFrame({"id": range(n), "a": rng.integers(0, 30, n).astype(float), "b": rng.integers(0, 9, n).astype(float), "c": rng.choice(list("pqrs"), n)})
    pdf["label"] = np.where(pdf.a > 18, 2.0, np.where(pdf.b > 4, 1.0, 0.0))
    noise = rng.random(n) < 0.15
    pdf.loc[noise, "label"] = rng.integers(0, 3, noise.sum()).astype(float)
    df = spark.createDataFrame(pdf).repartition(5)
    return pdf, df, VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def probabilities(model, vectors):
    return np.array([r["p"] for r in vectors.withColumn("p", model.probability(vectors)).orderBy("id").collect()])


def test_one_round_on_one_code_is_the_newton_step(rows):
    """Each code's score is the prior less the step times its sum of gradients over its sum of hessians."""
    pdf, df, _ = rows
    prep = m.Preprocessing(categorical=["c"], scale=False, one_hot=False)
    vectors = m.assemble(df, prep).transform(df)
    model = s.fit_softmax(vectors, m.FEATURES, "label", rounds=1, step=0.3, depth=4, min_leaf=1)
    share = np.array([(pdf.label == k).mean() for k in range(3)])
    scores = np.zeros((len(pdf), 3))
    for k in range(3):
        counts = pdf.assign(y=(pdf.label == k).astype(float)).groupby("c")["y"].agg(["sum", "count"])
        leaf = (counts["sum"] - share[k] * counts["count"]) / (counts["count"] * share[k] * (1 - share[k]) * 1.5)
        scores[:, k] = np.log(share[k]) + 0.3 * pdf["c"].map(leaf)
    assert np.allclose(probabilities(model, vectors), s.probabilities(scores))


def plain(x, labels, rounds, step, depth, min_leaf):
    """Rounds of recursive trees over all cuts."""
    k = int(labels.max()) + 1
    scores = np.tile(np.log([(labels == c).mean() for c in range(k)]), (len(x), 1))

    def tree(rows, g, h, left_depth):
        best = (1e-12, None, None)
        for f in range(x.shape[1]) if left_depth else ():
            for cut in np.unique(x[rows, f])[:-1]:
                sides = [rows[x[rows, f] <= cut], rows[x[rows, f] > cut]]
                if min(map(len, sides)) < min_leaf or min(h[r].sum() for r in sides) < s.LEAST_HESSIAN:
                    continue
                gain = sum(g[r].sum() ** 2 / h[r].sum() for r in sides) - g[rows].sum() ** 2 / h[rows].sum()
                if gain > best[0]:
                    best = (gain, sides, None)
        if best[1] is None:
            return [(rows, -step * g[rows].sum() / h[rows].sum())]
        return [leaf for side in best[1] for leaf in tree(side, g, h, left_depth - 1)]

    for _ in range(rounds):
        gradient, hessian = s.derivatives(scores, labels.astype(int))
        change = np.zeros_like(scores)
        for c in range(k):
            for rows, value in tree(np.arange(len(x)), gradient[:, c], hessian[:, c], depth):
                change[rows, c] = value
        scores = scores + change
    return s.probabilities(scores)


@pytest.mark.parametrize("collect_bytes", [64 << 20, 0])
def test_rounds_equal_a_plain_version(rows, monkeypatch, collect_bytes):
    pdf, _, vectors = rows
    monkeypatch.setattr(s, "COLLECT_BYTES", collect_bytes)
    monkeypatch.setattr(s, "KEPT_ROUNDS", 2)
    model = s.fit_softmax(vectors, "features", "label", rounds=3, step=0.2, depth=3, min_leaf=15)
    want = plain(pdf[["a", "b"]].to_numpy(), pdf["label"].to_numpy(), 3, 0.2, 3, 15)
    assert np.allclose(probabilities(model, vectors), want, atol=1e-9)


def test_learns_saves_and_handles_two_classes_and_unknown_labels(rows, tmp_path):
    pdf, df, _ = rows
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c"], scale=False, one_hot=False)
    partly = df.withColumn("label", F.when(F.col("id") % 5 > 0, F.col("label")))
    model = m.fit_softmax_trees(partly, prep, "label", rounds=8, depth=3)
    got = model.transform(df)
    assert got.columns == [*df.columns, "prediction"]
    assert got.where("prediction = label").count() > 0.8 * len(pdf)
    model.write().save(str(tmp_path / "model"))
    assert PipelineModel.load(str(tmp_path / "model")).transform(df).exceptAll(got).isEmpty()
    two = df.withColumn("label", (F.col("label") == 2).cast("double"))
    right = m.fit_softmax_trees(two, prep, "label", rounds=6, step=0.5, depth=2).transform(two).where("prediction = label").count()
    assert right > 0.85 * len(pdf)
