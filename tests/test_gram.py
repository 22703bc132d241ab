"""Least squares from sums and by steps, against closed forms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ledgerline.operators import gram as g
from ledgerline.operators import models as m
from ledgerline.operators.sparse_squares import sparse_least_squares


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 1600
    pdf = pd.DataFrame({
        "id": range(n), "a": rng.normal(50, 2, n), "b": rng.gamma(2, 3, n), "c": rng.choice(list("xyzw"), n, p=[0.5, 0.3, 0.15, 0.05]),
        "k": rng.integers(0, 6, n),
    })
    pdf["y"] = 3 + 2 * pdf.a - pdf.b + pdf.c.map({"x": 0.0, "y": 5.0, "z": -4.0, "w": 1.0}) + rng.normal(0, 0.5, n)
    pdf["z"] = pdf.a * pdf.b / 10
    pdf.loc[rng.random(n) < 0.1, "b"] = np.nan
    pdf.loc[rng.random(n) < 0.1, "c"] = None
    df = spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b"))).repartition(5)
    return pdf, df


def design(pdf, train, indicator=False, rare=0):
    columns = []
    for c in ("a", "b"):
        fill = train[c].median()
        base = train[c].fillna(fill)
        columns.append((pdf[c].fillna(fill) - base.mean()) / base.std(ddof=0))
        if indicator and train[c].isna().any():
            columns.append(pdf[c].isna().astype(float))
    for c in ("c", "k"):
        fill = train[c].mode()[0]
        counts = train[c].fillna(fill).value_counts()
        values = pdf[c].fillna(fill)
        common = counts[counts >= rare].index
        columns += [(values == v).astype(float) for v in common]
        if len(common) < len(counts):
            columns.append((~values.isin(common)).astype(float))
    return np.column_stack(columns)


def expected(pdf, train, target, alpha, intercept=True, **options):
    x, y = design(train, train, **options), train[target].to_numpy()
    mx, my = (x.mean(axis=0), y.mean()) if intercept else (0.0, 0.0)
    if alpha:
        w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    else:
        w = np.linalg.lstsq(x - mx, y - my, rcond=1e-10)[0]
    return (design(pdf, train, **options) - mx) @ w + my


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


PREP = m.Preprocessing(numeric=["a", "b"], categorical=["c", "k"])


@pytest.mark.parametrize("solver", ["sums", "steps"])
@pytest.mark.parametrize("alpha, intercept", [(10.0, True), (300.0, False), (None, True)])
def test_closed_form_with_nulls_and_modes(rows, solver, alpha, intercept):
    pdf, df = rows
    if solver == "sums":
        model = m.fit_ridge(df, PREP, "y", alpha, fit_intercept=intercept)
    else:
        model = sparse_least_squares(df, PREP, "y", alpha, intercept)
    assert np.allclose(predictions(model, df), expected(pdf, pdf, "y", alpha, intercept), atol=1e-6)


@pytest.mark.parametrize("solver", ["sums", "steps"])
def test_rare_and_unknown_categories(rows, solver):
    pdf, df = rows
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c", "k"], min_frequency=100)
    fit = m.fit_ridge if solver == "sums" else lambda *a: sparse_least_squares(*a, alpha=10.0)
    model = fit(df, prep, "y")
    assert np.allclose(predictions(model, df), expected(pdf, pdf, "y", 10.0, rare=100), atol=1e-6)
    unseen = predictions(model, df.where("c = 'w'").withColumn("c", F.lit("never")))
    assert np.allclose(unseen, predictions(model, df.where("c = 'w'")), atol=1e-9)


def test_null_marks_only_where_training_had_nulls(rows):
    pdf, df = rows
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c", "k"], indicator=True)
    model = m.fit_ridge(df, prep, "y", 5.0)
    assert np.allclose(predictions(model, df), expected(pdf, pdf, "y", 5.0, indicator=True), atol=1e-6)


def test_every_fold_and_target_from_one_table(rows, spark):
    """A fold left out equals a fit on the other folds; unknown answers count for their target alone."""
    pdf, df = rows
    part = df.withColumn("z", F.when(F.col("id") % 3 > 0, F.col("z"))).withColumn("f", F.col("id") % 4)
    table = g.gram_table(part, PREP, ["y", "z"], "f")
    known = pdf[pdf.id % 3 > 0]
    for without in (0, 3):
        for target, base in (("y", pdf), ("z", known)):
            train = base[base.id % 4 != without]
            model = table.solve(PREP, target, 10.0, without=without)
            assert np.allclose(predictions(model, df), expected(pdf, train, target, 10.0), atol=1e-6)


def test_cross_validation_equals_one_fit_per_fold(rows):
    pdf, df = rows
    prep = m.Preprocessing(numeric=["a"], categorical=["k"])
    fast = g.cross_validate_ridge(df, ["id"], ["y", "z"], prep, 3.0, folds=3).orderBy("target").collect()

    def fit(part):
        return PipelineModel([m.fit_ridge(part, prep, t, 3.0, prediction=f"{t}_prediction") for t in ("y", "z")])

    slow = m.cross_validate(df, ["id"], ["y", "z"], fit, folds=3).orderBy("target").collect()
    for a, b in zip(fast, slow):
        assert a["target"] == b["target"] and a["row_count"] == b["row_count"]
        assert np.allclose([a[c] for c in ("r2_mean", "r2_std", "mae_mean", "rmse_mean")], [b[c] for c in ("r2_mean", "r2_std", "mae_mean", "rmse_mean")])


def test_ten_thousand_columns_by_steps(spark):
    """One code column alone: ridge weights have a closed form for any number of codes."""
    codes, copies, alpha = 10_000, 3, 2.0
    pdf = pd.DataFrame({"id": range(codes * copies), "code": [f"k{i // copies}" for i in range(codes * copies)]})
    pdf["y"] = np.sin(np.arange(len(pdf)))
    df = spark.createDataFrame(pdf)
    prep = m.Preprocessing(categorical=["code"], categorical_fill=None)
    model = m.fit_ridge(df, prep, "y", alpha, fit_intercept=False)
    want = pdf.groupby("code")["y"].transform("sum") / (copies + alpha)
    assert np.allclose(predictions(model, df), want, atol=1e-8)


def test_saved_and_loaded(rows, tmp_path, spark):
    _, df = rows
    for name, model in (("sums", m.fit_ridge(df, PREP, "y")), ("steps", PipelineModel([sparse_least_squares(df, PREP, "y", 10.0)]))):
        model.write().save(str(tmp_path / name))
        loaded = PipelineModel.load(str(tmp_path / name))
        assert np.allclose(predictions(loaded, df), predictions(model, df))


def test_nulls_that_nothing_fills(rows):
    _, df = rows
    with pytest.raises(ValueError):
        m.fit_ridge(df, m.Preprocessing(numeric=["b"], numeric_fill=None), "y")
