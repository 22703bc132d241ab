"""Hard negatives against all pairs in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hard_negatives
from ledgerline.llm.hard_negatives import Bucket

SCHEMA = "vec_id bigint, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def plain(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in v]
        if i not in kept or (label, whole) < kept[i]:
            kept[i] = (label, whole)
    kept = {i: ((label + 1) % 10 if i % 7 == 0 else label, v) for i, (label, v) in kept.items()}
    found = set()
    for a, (label, v) in kept.items():
        if a % 100:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), o, other) for o, (other, w) in kept.items() if o != a)
        for ps, p, _ in [s for s in scores if s[2] == label][:5]:
            window = [s for s in scores if s[2] != label and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            found |= {(a, p, k + 1, n, -ps, -s) for k, (s, n, _) in enumerate(window[:10])}
    return found


def same(spark, rows, **settings):
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("id") % 100 == 0, moved, **settings).select(*COLUMNS).collect()
    want = plain(rows)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_given_embeddings(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table.collect()]
    got = hard_negatives.report(table).select(*COLUMNS).collect()
    assert {tuple(r) for r in got} == plain(rows) and len(got) == len(plain(rows))


def clustered(n, width, seed, lengths=False):
    """Tight clusters with labels that nearly follow them, so that coordinates prune."""
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rng.randrange(6)
        size = rng.choice([0.2, 1, 5]) if lengths else 1
        rows.append((i, [size * (x + rng.gauss(0, 0.3)) for x in centres[c]], c if rng.random() < 0.7 else rng.randrange(10)))
    return rows


@pytest.mark.parametrize("bucket_rows, focus", [(60, 3), (1000, 1)])
def test_clusters_of_several_lengths(spark, bucket_rows, focus):
    same(spark, clustered(700, 8, 4, lengths=True), bucket_rows=bucket_rows, focus=focus)


def test_copies_nulls_and_odd_values(spark):
    rows = clustered(350, 4, 7)
    rows += [(400 + i, [1.0, 0.0, 0.0, 0.0], i % 2) for i in range(60)]  # one vector a sixth of all
    rows += [(500, [1.0, 0.0, 0.0, 0.0], 3), (600, [0.0] * 4, 2), (601, [0.0] * 4, 3), (None, [1.0] * 4, 1), (700, None, 1),
             (800, [float("nan")] * 4, 1), (900, [1.0, None, 1.0, 1.0], 1), (901, [float("inf")] * 4, 2), (1000, [1.0] * 4, None),
             (1100, [], 1), (1200, [0.5, 0.5], 1), (1300, [-1.0] * 4, 9), (500, [1.0, 0.0, 0.0, 0.0], 3), (1201, [0.2] * 6, 1)]
    same(spark, rows, bucket_rows=50)


def test_very_large_components(spark):
    rows = [(i, [1e12 * ((i * 37) % 11 - 5), 1e12 * (i % 7), 3.0], i % 3) for i in range(220)]
    got = hard_negatives.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(-2 ** 63 <= r["negative_score"] < 2 ** 63 for r in got)


def test_no_rows(spark):
    assert hard_negatives.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_columns_are_not_read(spark):
    rows = clustered(150, 4, 2)
    wider = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", id int, bucket int")
    assert {tuple(r) for r in hard_negatives.report(wider).select(*COLUMNS).collect()} == plain(rows)


def test_coordinates_prune_and_lose_nothing():
    """The lists leave few rows, and all that reach the score."""
    rng = np.random.default_rng(1)
    points = rng.normal(size=(20, 16))[rng.integers(0, 20, 2000)] + rng.normal(scale=0.1, size=(2000, 16))
    vectors = np.floor(256 * points / np.linalg.norm(points, axis=1, keepdims=True)).astype(int)
    bucket = Bucket(range(2000), [0] * 2000, vectors.tolist())
    left = 0
    for a in vectors[:50]:
        scores = vectors @ a
        floor = int(np.sort(scores)[-5])
        near = bucket.candidates(a.astype(float), floor, 3)
        assert set(np.flatnonzero(scores >= floor)) <= set(near.tolist())
        left += len(near)
    assert left < 0.4 * 50 * 2000
