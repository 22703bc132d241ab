"""Boosting by passes over blocks against the same on one block, closed forms and a plain version."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerline.operators import boosting as b
from ledgerline.operators import models as m
from ledgerline.operators import softmax as s


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "a": rng.integers(0, 40, n).astype(float), "b": rng.integers(0, 9, n).astype(float), "c": rng.choice(list("pqrst"), n)})
    pdf["y"] = 100 + 3 * pdf.a - pdf.b ** 2 + pdf.c.map({"p": 9, "q": -20, "r": 5, "s": 30, "t": -2}) + rng.normal(0, 1, n)
    pdf["flag"] = (pdf.y > 150).astype(float)
    pdf["label"] = (pdf.a // 14).clip(0, 2)
    return pdf, spark.createDataFrame(pdf).repartition(6)


PREP = m.Preprocessing(numeric=["a", "b"], categorical=["c"], scale=False, one_hot=False)


def predicted(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


def plain(x, y, loss, trees, step, depth):
    """Rounds of recursive regression trees over all cuts of ordered columns."""
    def tree(rows, r, left_depth):
        best = (1e-9, None)
        for f in range(x.shape[1]) if left_depth else ():
            for cut in np.unique(x[rows, f])[:-1]:
                sides = [rows[x[rows, f] <= cut], rows[x[rows, f] > cut]]
                gain = sum(r[s].sum() ** 2 / len(s) for s in sides) - r[rows].sum() ** 2 / len(rows)
                if gain > best[0] * (1 + 1e-9):
                    best = (gain, sides)
        if best[1] is None:
            return [(rows, r[rows].mean())]
        return [leaf for side in best[1] for leaf in tree(side, r, left_depth - 1)]

    score = np.zeros(len(x))
    for number in range(trees):
        sign = 2 * y - 1
        first = y if loss == "squares" else sign
        rest = 2 * (y - score) if loss == "squares" else 4 * sign / (1 + np.exp(2 * sign * score))
        change = np.zeros(len(x))
        for rows, value in tree(np.arange(len(x)), rest if number else first, depth):
            change[rows] = value * (step if number else 1.0)
        score = score + change
    return score if loss == "squares" else (score > 0).astype(float)


@pytest.mark.parametrize("local_rows", [0, 1 << 16])
@pytest.mark.parametrize("loss,target", [("squares", "y"), ("logistic", "flag")])
def test_rounds_equal_a_plain_version(rows, monkeypatch, loss, target, local_rows):
    pdf, df = rows
    monkeypatch.setattr(b, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(b, "KEPT_ROUNDS", 2)
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    model = b.BoostedTrees(loss, "features", target, 4, 0.2, 3, 64).fit(vectors)
    want = plain(pdf[["a", "b"]].to_numpy(), pdf[target].to_numpy(), loss, 4, 0.2, 3)
    assert np.allclose(predicted(model, vectors), want, atol=1e-6)


def test_codes_are_split_into_sets(rows):
    """One split on one code column separates the two groups of codes with the most different means."""
    pdf, df = rows
    prep = m.Preprocessing(categorical=["c"], scale=False, one_hot=False)
    model = m.fit_model(df, prep, m.gradient_boosting("y", trees=1, depth=1), "y")
    got = pd.Series(predicted(model, df)).groupby(pdf["c"].to_numpy()).first()
    high = [c for c in "pqrst" if got[c] == got["s"]]
    assert np.isclose(got["s"], pdf[pdf.c.isin(high)].y.mean()) and got["q"] < got["s"] and got.nunique() == 2


@pytest.mark.parametrize("collect_bytes", [64 << 20, 0])
def test_layout_does_not_change_a_tree(rows, monkeypatch, collect_bytes):
    _, df = rows
    fits = {
        "y": lambda part: m.fit_model(part, PREP, m.gradient_boosting("y", trees=6, max_bins=64), "y"),
        "flag": lambda part: m.fit_model(part, PREP, m.boosted_classifier("flag", trees=6, max_bins=64), "flag"),
        "label": lambda part: m.fit_softmax_trees(part, PREP, "label", rounds=4, depth=3),
    }
    for fit in fits.values():
        monkeypatch.setattr(b, "LOCAL_ROWS", 1 << 16)
        alone = [r["body"] for r in fit(df).stages[-2].tables["rounds"].orderBy("round").collect()]
        monkeypatch.setattr(b, "LOCAL_ROWS", 0)
        for module in (b, s):
            monkeypatch.setattr(module, "COLLECT_BYTES", collect_bytes)
        dealt = [r["body"] for r in fit(df).stages[-2].tables["rounds"].orderBy("round").collect()]
        assert [bytes(x) for x in alone] == [bytes(x) for x in dealt]


def test_labels_and_probabilities(rows):
    _, df = rows
    made = m.fit_model(df, PREP, m.boosted_classifier("flag", trees=20, max_bins=64), "flag").transform(df)
    assert made.columns == [*df.columns, "rawPrediction", "probability", "prediction"]
    assert made.where("prediction = flag").count() > 0.95 * made.count()
    with pytest.raises(ValueError, match="labels"):
        m.fit_model(df, PREP, m.boosted_classifier("y"), "y")
    with pytest.raises(ValueError, match="no rows"):
        m.fit_model(df.withColumn("y", F.lit(None).cast("double")), m.Preprocessing(numeric=["a"], numeric_fill=0, scale=False), m.gradient_boosting("y"), "y")


def test_cuts_of_few_rows_are_even():
    values = np.array([0.0] * 2 + [1.0] * 50 + [2.0] * 40 + [3.0] * 8)
    assert b.even_cuts(values, 5).tolist() == [0.5, 1.5, 2.5]
    assert b.even_cuts(np.arange(100.0), 3).tolist() == [24.5, 49.5, 74.5]
    assert b.even_cuts(np.ones(5), 3).tolist() == []


def test_sums_of_joined_features_are_those_of_each():
    """Walks and sums against plain ones, for nodes with rows and one without."""
    rng = np.random.default_rng(3)
    widths, n = [7, 300, 2, 40, 1], 5000
    ends = np.cumsum(widths).tolist()
    bins = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint16)
    assert b.joint_features(ends) == [[4, 2, 0, 3], [1]]
    tree = b.Grown()
    low, high = tree.branch(0, 1, np.arange(300) <= 120, 1.0, 2.0)
    tree.branch(low, 3, np.arange(40) % 2 == 0, 3.0, 4.0)
    none, _ = tree.branch(high, 0, np.zeros(7, bool), 5.0, 6.0)
    arrays = tree.arrays()
    place = np.where(bins[1] <= 120, np.where(bins[3] % 2 == 0, 3, 4), 6)
    assert (b.leaves(bins, arrays) == arrays[4][place]).all()
    weight = rng.integers(-9, 9, n).astype(float)
    lists = b.rows_through(bins, arrays, [3, none, 6])
    rows = np.concatenate(lists)
    sums = b.bin_sums(b.joint_bins(bins, ends), ends, lists, [weight[rows]])
    for i, node in enumerate((3, none, 6)):
        for f, end in enumerate(ends):
            own = bins[f][place == node]
            for table, w in zip(sums[:, i], (None, weight[place == node])):
                assert (table[end - widths[f]:end] == np.bincount(own, w, widths[f])).all()


def test_a_block_has_a_feature_in_one_piece():
    plan = b.Boosting("squares", [0.0], [3, 6], 2, None, None, None)
    packs = [{"bins": np.array([[0, 1], [2, 0]], np.uint16).tobytes(), "answers": np.array([1.0, 2.0]).tobytes()}] * 2
    bins, y, scores = next(b.blocks_in(iter(packs), plan))
    assert bins.flags["C_CONTIGUOUS"] and bins.tolist() == [[0, 2, 0, 2], [1, 0, 1, 0]] and y.tolist() == [1, 2, 1, 2]


def test_bundles_are_fitted_on_rows_that_are_joined_once(spark, folder, monkeypatch):
    from ledgerline.plans.catalog import learners

    seen = []

    def seeing(fit):
        def run(train, *args, **options):
            seen.append(train.storageLevel)
            return fit(train, *args, **{**options, "trees": 1})
        return run

    for name in ("fit_continuous_target", "fit_two_stage_target", "fit_fixed_amount_target"):
        monkeypatch.setattr(learners.m, name, seeing(getattr(learners.m, name)))
    row = learners.predict_bundle(spark, folder).first()
    assert len(seen) == 3 and all(level.useMemory and level.useDisk for level in seen)
    assert row["row_count"] > 0 and row["negative_rows"] == row["rows_off_the_sum"] == row["unknown_amounts"] == 0
