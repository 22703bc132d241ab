import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import evaluation as ev
from ledgerline.operators import results as res
from ledgerline.operators.statistics import residual_summary


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(2)
    actual = rng.gamma(2, 25, 300)
    pdf = pd.DataFrame({"y": actual, "p": actual + rng.normal(0, 8, 300)})
    return pdf, spark.createDataFrame(pdf)


def by_hand(pdf):
    e = pdf.p - pdf.y
    return [len(pdf), e.abs().mean(), np.sqrt((e**2).mean()), e.abs().median(), 1 - (e**2).sum() / ((pdf.y - pdf.y.mean()) ** 2).sum()]


def test_metrics_and_bands(scored):
    pdf, df = scored
    assert np.allclose(list(ev.regression_metrics(df, "y", "p").first()), by_hand(pdf))
    bands = pd.cut(pdf.y, [-np.inf, 30, 60, 100, np.inf], right=False, labels=ev.AMOUNT_BAND_LABELS)
    got = {r["band"]: list(r)[1:] for r in ev.band_metrics(df, "y", "p").collect()}
    for band, group in pdf.groupby(bands, observed=True):
        assert np.allclose(got[band], by_hand(group))
    assert len(got) == bands.nunique()


def test_one_row_band_has_no_r2(spark):
    df = spark.createDataFrame([(10.0, 11.0), (12.0, 12.0), (500.0, 400.0)], "y double, p double")
    got = {r["band"]: r for r in ev.band_metrics(df, "y", "p").collect()}
    assert got["100_plus"]["r2"] is None and got["100_plus"]["median_ae"] == 100.0
    assert ev.band_bias(df.withColumn("y", -F.col("y")), "y", "p").isEmpty()


def test_guards(spark):
    ev.require_scorable(spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "y double, p double"), "y", "p")
    for rows in ([(1.0, 1.0)], [(1.0, 1.0), (2.0, None)], [(1.0, 1.0), (float("inf"), 2.0)], [(1.0, float("nan")), (2.0, 2.0)]):
        with pytest.raises(ValueError):
            ev.require_scorable(spark.createDataFrame(rows, "y double, p double"), "y", "p")


def test_classification_with_unseen_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1), (0, 0)], "a int, p int")
    row = ev.classification_metrics(df, "a", "p", positive=1, baseline=0).first()
    assert row["row_count"] == 5 and np.isclose(row["accuracy"], 0.6) and np.isclose(row["binary_f1"], 0.5)
    assert np.isclose(row["weighted_f1"], (3 * 0.8 + 1 * 0.5 + 0) / 5) and np.isclose(row["baseline_accuracy"], 0.6)
    none = spark.createDataFrame([(0, 0)], "a int, p int")
    assert ev.classification_metrics(none, "a", "p", positive=1).first()["binary_f1"] == 0.0


def test_multi_target_leaves_unknown_answers_out(spark):
    df = spark.createDataFrame([(1.0, None, 3.0, 1.0, 2.0), (2.0, 4.0, 6.0, 2.0, 5.0)], "a double, b double, t double, pa double, pb double")
    got = {r["target"]: r for r in ev.multi_target_eval(df, {"a": "pa", "b": "pb"}, "t").collect()}
    assert got["a"]["mae"] == 0.0 and got["b"]["row_count"] == 1 and got["b"]["r2"] is None
    assert np.isclose(got["t"]["mae"], 0.5)
    assert ev.part_sum_mae(df, ["a", "b"], "t").first()["row_count"] == 1


def test_residuals(scored):
    pdf, df = scored
    e = pdf.p - pdf.y
    row = residual_summary(df, "y", "p").first()
    lo, hi = e.quantile([0.01, 0.99])
    assert np.allclose([row["lower_bound"], row["upper_bound"]], [lo, hi]) and row["rows_inside"] == e.between(lo, hi).sum()


def record(author, mae, **data):
    base = {"train_rows": 80, "test_rows": 20, "excluded_test_rows": 0, "split_id": "s", "leakage_check": True}
    base.update(data)
    return {
        "experiment_id": f"{author}_v1", "author": author, "target": "total",
        "metrics": {"mae": mae, "rmse": 2.0, "median_ae": 1.0, "r2": 0.5}, "data": base, "fare_bands": [],
        "artifacts": {"report": None, "model": None},
    }


def test_leaderboard_reads_records_and_checks_authors(spark, tmp_path):
    runs = [
        record("ann", 3.0), record("bob", 1.0), record("cy", 0.1, leakage_check=False),
        record("di", 0.2, excluded_test_rows=None), record("ed", 0.3, test_rows=19),
    ]
    for r in runs:
        (tmp_path / r["author"]).mkdir()
        (tmp_path / r["author"] / "metrics.json").write_text(json.dumps(r, indent=1))
    board = res.leaderboard(res.load_results(spark, str(tmp_path)), "total", "s", 20, source="source").collect()
    assert [r["author"] for r in board] == ["bob", "ann", "cy", "di", "ed"]
    assert [r["eligible"] for r in board] == [True, True, False, False, False]
    assert [r["rank"] for r in board] == [1, 2, 3, 4, 5] and "bob/metrics.json" in board[0]["source"]
    (tmp_path / "eve").mkdir()
    (tmp_path / "eve" / "metrics.json").write_text(json.dumps(record("mallory", 1.0)))
    with pytest.raises(ValueError, match="folder"):
        res.load_results(spark, str(tmp_path))


def test_missing_records(spark, tmp_path):
    (tmp_path / "x").mkdir()
    with pytest.raises(Exception):
        res.load_results(spark, str(tmp_path))


def test_record_round_trip(spark, scored, tmp_path):
    from ledgerline.sources.sinks import load_saved_results, save_results

    _, df = scored
    made = res.metrics_record(
        ev.regression_metrics(df, "y", "p"), ev.band_metrics(df, "y", "p"), "e1", "ann", "total", 10, 300, "s", True
    )
    back = save_results(made, str(tmp_path / "out"))
    assert back.schema == res.RESULT_SCHEMA
    assert json.loads(back.toJSON().first()) == json.loads(made.toJSON().first())
    moved = tmp_path / "out" / "author_folder=bob"
    (tmp_path / "out" / "author_folder=ann").rename(moved)
    with pytest.raises(ValueError, match="folder"):
        load_saved_results(spark, str(tmp_path / "out"))
    broken = made.withColumn("author", F.lit(""))
    with pytest.raises(ValueError, match="author is empty"):
        save_results(broken, str(tmp_path / "bad"))


def test_best_and_reduction(spark):
    table = spark.createDataFrame([("base", 0.1), ("a", 2.0), ("b", 1.0)], "experiment string, mae double")
    assert res.best_by_metric(table, "experiment", "mae", ["base"]).first()["experiment"] == "b"
    df = spark.createDataFrame([(10.0, 9.0, 6.0)], "y double, p double, b double")
    assert ev.baseline_reduction(df, "y", "p", "b").first()["reduction_percent"] == 75.0
