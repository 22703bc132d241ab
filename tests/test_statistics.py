import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.functions.distributions import regularized_beta, t_two_sided_p
from ledgerline.operators import eda
from ledgerline.operators import statistics as st


def test_t_tail_known_values():
    # Closed forms: df = 1 is Cauchy, df = 2 is algebraic.
    for t in (0.1, 1.0, 3.5, 40.0):
        assert math.isclose(t_two_sided_p(t, 1), 1 - 2 / math.pi * math.atan(t), rel_tol=1e-10)
        assert math.isclose(t_two_sided_p(-t, 2), 1 - t / math.sqrt(2 + t * t), rel_tol=1e-9)
    assert t_two_sided_p(0.0, 5) == 1.0 and t_two_sided_p(1e6, 1e6) == 0.0
    assert math.isclose(t_two_sided_p(-4.06756, 400_000), 4.7515e-05, rel_tol=1e-3)
    assert regularized_beta(2, 3, 0) == 0 and regularized_beta(2, 3, 1) == 1


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 500).astype(float), "b": rng.normal(0, 1, 500), "g": rng.integers(1, 4, 500)})
    pdf["c"] = pdf.a * 0.3 + rng.normal(0, 1, 500)
    pdf.loc[::10, "a"] = None
    return pdf, spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, g int, c double")


def test_describe_matches_pandas(data):
    pdf, df = data
    expected = pdf[["a", "b", "c"]].describe().T
    for r in st.describe_table(df, ["a", "b", "c"]).collect():
        e = expected.loc[r["column"]]
        assert np.allclose(list(r)[1:], [e[c] for c in ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]])


def test_correlations_are_pairwise_complete(data):
    pdf, df = data
    expected = pdf[["a", "b", "c"]].corr()
    got = st.correlation_matrix(df, ["a", "b", "c"]).collect()
    assert len(got) == 9
    assert all(np.isclose(r["r"], expected.loc[r["col_a"], r["col_b"]]) for r in got)
    top = st.target_correlations(df, "c", ["a", "b"]).collect()
    assert [r["column"] for r in top] == expected["c"].drop("c").sort_values(ascending=False).index.tolist()


def test_ranks_and_spearman(data):
    pdf, df = data
    ranks = {r["a"]: r["rank"] for r in st.average_rank(df, "a").collect()}
    known = pdf.dropna(subset=["a"])
    assert np.allclose(known.a.map(ranks), known.a.rank())
    row = st.spearman(df, "a", "c").first()
    assert row["row_count"] == len(known)
    assert np.isclose(row["rho"], known.a.rank().corr(known.c.rank()))


def test_welch_by_hand(data):
    pdf, df = data
    row = st.welch_ttest(df, "c", F.col("g") == 1, F.col("g") == 2, "one", "two").first()
    x, y = pdf[pdf.g == 1].c, pdf[pdf.g == 2].c
    sx, sy = x.var() / len(x), y.var() / len(y)
    t = (x.mean() - y.mean()) / np.sqrt(sx + sy)
    dof = (sx + sy) ** 2 / (sx**2 / (len(x) - 1) + sy**2 / (len(y) - 1))
    assert np.isclose(row["t_statistic"], t) and np.isclose(row["degrees_of_freedom"], dof)
    assert np.isclose(row["p_value"], t_two_sided_p(t, dof)) and row["significant"] == (row["p_value"] < 0.05)
    with pytest.raises(ValueError):
        st.welch_ttest(df, "c", F.col("g") == 1, F.col("g") == 99, "one", "none")


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (9.99,), (10.0,), (10.01,), (-0.1,), (None,)], "v double")
    got = [r["row_count"] for r in eda.histogram(df, "v", 0.0, 10.0, 10).collect()]
    assert got == [1, 1, 0, 0, 0, 0, 0, 0, 0, 2]


def test_zero_ratio_counts_null_as_non_zero(spark):
    df = spark.createDataFrame([(0.0,), (None,), (2.0,), (0.0,)], "v double")
    assert eda.zero_ratio(df, ["v"]).first()["zero_ratio"] == 0.5
    row = eda.nonzero_ratio(df, ["v"]).first()
    assert row["row_count"] == 3 and np.isclose(row["nonzero_rate"], 1 / 3)
