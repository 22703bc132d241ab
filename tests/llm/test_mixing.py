"""Raking and sampling against plain iterative fitting."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing
from ledgerline.llm.common import documents


def fit(table, targets, sweeps=500):
    weights = table / table.sum()
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            others = tuple(i for i in range(weights.ndim) if i != axis)
            sums = weights.sum(axis=others)
            shape = [-1 if i == axis else 1 for i in range(weights.ndim)]
            weights = weights * np.divide(target, sums, out=np.zeros_like(sums), where=sums > 0).reshape(shape)
    return weights


def goals(held, target, size):
    """Tokens per category: all it holds where its target takes more, equal multiples of the targets elsewhere."""
    whole = np.zeros(len(held), bool)
    while True:
        level = (size - held[whole].sum()) / target[~whole].sum()
        if (more := held < target * level).sum() == whole.sum():
            return np.where(more, held, target * level)
        whole = more


def bounded(weights, table, targets, met, sweeps=3000):
    """Expected tokens per cell: the weights times a factor per category, at most what the cell holds."""
    filled = table > 0
    ratio = np.divide(weights, table, out=np.zeros_like(weights), where=filled)
    full = np.percentile(np.repeat(ratio[filled], table[filled].astype(int)), 100 * met)
    size = min(1 / full, table.sum())
    asked = weights * size
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            others = tuple(i for i in range(table.ndim) if i != axis)
            goal = goals(table.sum(axis=others), target, size)
            for c in range(len(goal)):
                own = np.take(asked, c, axis)
                limit = np.take(table, c, axis)
                total, free = np.minimum(own, limit).sum(), own[own < limit].sum()
                by = goal[c] / total if total > goal[c] else 1 + (goal[c] - total) / free if free > 0 else 1.0
                index = [slice(None)] * table.ndim
                index[axis] = c
                asked[tuple(index)] = own * by
    return np.minimum(asked, table)


def test_given_documents(spark):
    docs = mixing.with_tokens_and_topic(documents(spark, "/root/testdata/sf0.01"))
    rows = mixing.mix(docs).select("doc_id", "source", "lang", "topic", "tokens", "weight", "probability", "sampled").collect()
    axes = [sorted({r[d] for r in rows}) for d in mixing.DIMENSIONS]
    table = np.zeros([len(a) for a in axes])
    place = lambda r: tuple(a.index(r[d]) for a, d in zip(axes, mixing.DIMENSIONS))
    for r in rows:
        table[place(r)] += r["tokens"]
    targets = []
    for axis, name in enumerate(mixing.DIMENSIONS):
        shares = table.sum(axis=tuple(i for i in range(3) if i != axis))
        raised = np.where(shares > 0, (shares / shares.sum()) ** mixing.TEMPER[name], 0)
        targets.append(raised / raised.sum())
    want = fit(table, targets)
    expected = bounded(want, table, targets, mixing.MET)
    for r in rows:
        assert r["weight"] == pytest.approx(want[place(r)], rel=1e-4)
        held = table[place(r)]
        assert r["probability"] == pytest.approx(expected[place(r)] / held if held else 0.0, rel=1e-3, abs=1e-6)
    assert sum(r["probability"] > 0.3 for r in rows) > 0.9 * len(rows)
    drawn = sum(r["tokens"] for r in rows if r["sampled"])
    expected = sum(r["tokens"] * r["probability"] for r in rows)
    assert drawn == pytest.approx(expected, rel=0.15)
    again = {r["doc_id"] for r in mixing.mix(docs.repartition(7)).where("sampled").collect()}
    assert again == {r["doc_id"] for r in rows if r["sampled"]}


def test_given_targets_hold_in_the_sample(spark):
    rows = [(i, "w " * 20, "ab"[i % 10 == 0], "xyz"[i % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, topic string").withColumn("lang", F.lit("en")).withColumn("tokens", F.lit(20))
    targets = {"source": {"a": 0.5, "b": 0.5, "unseen": 3.0}, "topic": {"x": 0.2, "y": 0.3, "z": 0.5}, "lang": {"en": 1.0}}
    got = mixing.mix(docs, targets, met=1.0).where("sampled").groupBy("source", "topic").count().collect()
    total = sum(r["count"] for r in got)
    for name, shares in (("source", {"a": 0.5, "b": 0.5}), ("topic", targets["topic"])):
        for value, share in shares.items():
            assert sum(r["count"] for r in got if r[name] == value) / total == pytest.approx(share, abs=0.05)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "s", "en"), (None, "some words here", None, "en"), (3, "more words", "s", None), (3, "more words", "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").selectExpr("*", "'t' AS tokens", "1 AS weight", "2 AS extra")
    out = mixing.mix(mixing.with_tokens_and_topic(docs)).collect()
    assert len(out) == 5 and all(0 <= r["probability"] <= 1 and r["extra"] == 2 for r in out)
    twins = [r["sampled"] for r in out if r["doc_id"] == 3]
    assert twins[0] == twins[1]
    assert len(mixing.report(docs).collect()) == 5
    assert mixing.sampled(docs).columns == docs.columns
    assert mixing.report(docs.limit(0)).collect() == [] and mixing.sampled(docs.limit(0)).collect() == []


def test_default_setting_meets_its_targets(spark):
    """The rare source and the rare topic are wanted far above their share; targets hold or are named infeasible."""
    rows = [(i, "w " * 20, "b" if i % 25 == 0 else "a", "r" if i % 40 == 7 else "xy"[i % 2]) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, topic string").withColumn("lang", F.lit("en")).withColumn("tokens", F.lit(20))
    targets = {"source": {"a": 0.95, "b": 0.05}, "topic": {"x": 0.5, "y": 0.43, "r": 0.07}, "lang": {"en": 1.0}}
    rows = mixing.mix(docs, targets).select("source", "topic", "tokens", "probability").collect()
    sizes = {}
    for r in rows:
        for d in ("source", "topic"):
            sizes[d, r[d]] = sizes.get((d, r[d]), 0) + r["tokens"] * r["probability"]
    total = sum(r["tokens"] * r["probability"] for r in rows)
    found = {(r["dimension"], r["category"]): r for r in mixing.achieved(docs, targets).collect()}
    held = {k: sum(r["tokens"] for r in rows if r[k[0]] == k[1]) for k in sizes}
    assert all(0 <= r["probability"] <= 1 for r in rows)
    assert all(f["off"] < 1e-4 for f in found.values())
    for d in ("source", "topic"):
        free = {c: t for c, t in targets[d].items() if not found[d, c]["infeasible"]}
        left = total - sum(sizes[d, c] for c in targets[d] if c not in free)
        for c, share in targets[d].items():
            assert found[d, c]["expected"] == pytest.approx(sizes[d, c] / total, rel=1e-6)
            if c in free:
                assert sizes[d, c] == pytest.approx(left * share / sum(free.values()), rel=1e-3)
            else:
                assert sizes[d, c] == pytest.approx(held[d, c], rel=1e-3) and held[d, c] < share * total
    assert {k for k, f in found.items() if f["infeasible"]} == {("topic", "r"), ("source", "b")}


def test_query_and_stage_draw_the_same_documents(spark, folder):
    docs = documents(spark, folder)
    told = {r["doc_id"] for r in mixing.report(docs).where("sampled").select("doc_id").collect()}
    assert told == {r["doc_id"] for r in mixing.sampled(docs).select("doc_id").collect()}
