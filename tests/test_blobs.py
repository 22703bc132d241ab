"""Rows that boosting keeps in files: walked as cells, and nothing left behind."""

from pathlib import Path

import numpy as np
import pytest

from ledgerline.operators import boosting as b
from ledgerline.operators import models as m
from ledgerline.operators import trees as t
from ledgerline.session import shared_folder
from ledgerline.sources import blobs


def test_walks_over_cells_are_those_over_bins():
    rng = np.random.default_rng(5)
    widths, n = [7, 300, 2, 40, 1], 3000
    ends = np.cumsum(widths).tolist()
    bins = np.stack([rng.integers(0, w, n) for w in widths]).astype(np.uint16)
    tree = b.Grown()
    low, high = tree.branch(0, 3, rng.random(40) < 0.5, 1.0, 2.0)
    tree.branch(low, 1, np.arange(300) <= 100, 3.0, 4.0)
    tree.branch(high, 0, np.arange(7) % 2 == 0, 5.0, 6.0)
    cells, arrays = b.cells_of(bins, ends), b.on_cells(tree.arrays(), ends)
    assert cells.shape == (2, n)
    assert (b.leaves(cells, arrays) == b.leaves(bins, tree.arrays())).all()


def test_rounds_leave_no_files_and_keep_no_rows_in_the_session(spark, monkeypatch):
    monkeypatch.setattr(b, "LOCAL_ROWS", 0)
    rows = spark.createDataFrame([(float(i % 9), float(i % 7), float(i % 9 > 3) * 50 + i % 7) for i in range(400)], "a double, b double, y double").repartition(4)
    sizes = []
    whole = b.spread_sums
    monkeypatch.setattr(b, "spread_sums", lambda parts, folder, *a: sizes.append(len(list(Path(folder.removeprefix("file:")).iterdir()))) or whole(parts, folder, *a))

    def left() -> set[Path]:
        return {p for p in Path(shared_folder(spark)).rglob("*") if p.is_file()}

    before = left()
    m.fit_model(rows, m.Preprocessing(numeric=["a", "b"], scale=False), m.gradient_boosting("y", trees=30, depth=2), "y")
    assert left() == before
    assert max(sizes) <= 3 * sizes[0]  # rows, and scores of two rounds at most


def test_a_file_appears_only_whole(tmp_path):
    uri = f"file:{tmp_path}/a/b"
    with pytest.raises(ValueError), blobs.written(uri) as out:
        out.write(b"half")
        raise ValueError
    assert not Path(tmp_path, "a/b").exists()
    with blobs.written(uri) as out:
        out.write(b"whole")
    with blobs.opened(uri) as stream:
        assert stream.read() == b"whole"
    blobs.remove([uri, uri, f"file:{tmp_path}/none"])
    assert not Path(tmp_path, "a/b").exists()


def test_all_parts_of_all_bundles_are_scored_in_one_python_step(spark):
    rows = spark.createDataFrame([(i, float(i % 9), float(i % 7), float(i % 3), float(max(i % 5 - 1, 0))) for i in range(400)], "id int, a double, b double, x double, y double")
    prep = m.Preprocessing(numeric=["a", "b"], scale=False)
    bundles = {"x": m.fit_fixed_amount_target(rows, prep, "x", trees=2), "y": m.fit_two_stage_target(rows, prep, "y", trees=2),
               "b": m.fit_continuous_target(rows, prep, "b", trees=2)}
    scored = m.predict_bundles(bundles, rows)
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert scored.columns == [*rows.columns, "x_prediction", "y_prediction", "b_prediction", "total_prediction"]
    together = [tuple(r) for r in scored.orderBy("id").select("x_prediction", "y_prediction", "b_prediction").collect()]
    alone = [[r["p"] for r in b.predict(rows, "p").orderBy("id").collect()] for b in bundles.values()]
    assert together == list(zip(*alone))
    first = bundles["y"].parts["classifier"].transform(rows).select("id", "prediction").orderBy("id").collect()
    assert all((row[1] == 0.0) or r["prediction"] == 1.0 for row, r in zip(together, first))


def test_few_trees_are_brought_together_at_a_time(spark, monkeypatch):
    """The trees are the same in groups of one, and their rows' files are gone before the next group's."""
    rows = spark.createDataFrame([(i, float(i % 9), float(i % 7), float(i % 9 > 3) * 50 + i % 7) for i in range(900)], "id int, a double, b double, y double").repartition(4)
    folders = []
    whole = t.finished

    def seeing(*args):
        folders.append(len([p for p in Path(shared_folder(spark)).glob("forest-*") if p.exists()]))
        return whole(*args)

    monkeypatch.setattr(t, "finished", seeing)
    made = []
    for size in (t.DEALT_BYTES, 1):
        monkeypatch.setattr(t, "DEALT_BYTES", size)
        monkeypatch.setattr(t, "RUN_BYTES", size)
        model = m.fit_forest_multi(rows, m.Preprocessing(numeric=["a", "b"], scale=False), ["y"], trees=5, depth=6, min_leaf=2)
        made.append([r["y_prediction"] for r in model.transform(rows).orderBy("id").collect()])
    assert np.allclose(*made)
    assert folders == [folders[0]] * 6
