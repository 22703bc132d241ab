"""Held-out accuracy of the two classifiers, and the parts they are made of."""

import zlib

import numpy as np
import pytest

from ledgerline.llm import language, ngrams, quality_model
from ledgerline.llm.common import documents

MEDIUM = "/root/testdata/sf0.01"


def remainder(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def test_language_of_held_out_documents(spark):
    docs = documents(spark, MEDIUM)
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = language.report(docs).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    assert all(r["held_out"] == (remainder(r["doc_id"], 3) == 1) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    hidden = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in hidden]) > 0.95


def test_language_never_sees_held_out_labels(spark, folder):
    docs = documents(spark, folder)
    other = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS string) AS binary)) % 3 = 1, 'xx', lang) AS lang", "'s' AS score")
    assert sorted(map(tuple, language.report(docs).collect())) == sorted(map(tuple, language.report(other).collect()))


def test_language_of_odd_texts(spark, folder):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !? \n", None), (None, "Ab", "de"), (4, "x" * 3_000_000, None), (4, "é", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    plain = documents(spark, folder).select("doc_id", "text", "lang")
    got = language.report(plain.withColumn("doc_id", plain.doc_id + 100).union(odd)).where("doc_id < 100 OR doc_id IS NULL").collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)} == {"und"}
    assert {r["lang_pred"] for r in got if r["doc_id"] in (4, None)} <= {"en", "de", "fr", "es"}
    assert len(got) == 6
    assert language.report(odd.limit(0)).collect() == []
    assert {r["lang_pred"] for r in language.report(odd.where("lang IS NULL")).collect()} == {"und"}


def test_buckets_do_not_depend_on_blocks(monkeypatch):
    text = "The quick brown fox é 𝒳 " * 50
    whole = ngrams.counts(text)
    monkeypatch.setattr(ngrams, "BLOCK", 97)
    assert (ngrams.counts(text) == whole).all()
    assert whole.sum() == sum(len(text) - n + 1 for n in ngrams.ORDERS)


def test_document_frequencies_count_all_rows(spark, folder):
    rows = documents(spark, folder).select("text").limit(60).collect()
    df = spark.createDataFrame([(r["text"], i % 2) for i, r in enumerate(rows)], "text string, class int").repartition(5)
    want = np.zeros((2, ngrams.SIZE), np.int64)
    for i, r in enumerate(rows):
        want[i % 2] += ngrams.counts(r["text"]) > 0
    assert (ngrams.document_frequencies(df, 2, lower=False) == want).all()


def test_l1_leaves_weights_at_zero():
    rng = np.random.default_rng(1)
    vectors, kinds = [], rng.integers(0, 3, 300)
    for kind in kinds:
        used = np.unique(np.r_[kind, rng.integers(10, 2000, 20)])
        vectors.append((used, np.ones(len(used)) / np.sqrt(len(used))))
    weights, bias = language.ftrl_fit(vectors, kinds, 3)
    guess = [int((v @ weights[u] + bias).argmax()) for u, v in vectors]
    assert np.mean(guess == kinds) == 1
    assert np.count_nonzero(weights) < 2000


def test_temperature_recovers_scale():
    rng = np.random.default_rng(2)
    logits = rng.normal(size=(20_000, 4))
    chances = language.softmax(logits)
    kinds = (chances.cumsum(axis=1) > rng.random((len(logits), 1))).argmax(axis=1)
    assert language.best_temperature(logits * 5, kinds) == pytest.approx(5, rel=0.1)


def test_quality_of_held_out_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality_model.report(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r["predicted"] == int(r["score"] >= 0.7) and r["held_out"] == (remainder(r["doc_id"], 4) == 2) for r in got)
    hidden = [(r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = np.array([s for s, q in hidden if q == 1]), np.array([s for s, q in hidden if q == 0])
    area = np.mean(good[:, None] > bad[None, :]) + 0.5 * np.mean(good[:, None] == bad[None, :])
    print("area", area, "kept good", np.mean(good >= 0.7), "kept bad", np.mean(bad >= 0.7))
    assert area > 0.9 and np.mean(good >= 0.7) > 0.9


def test_quality_of_odd_rows(spark, folder):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "a" * 2_000_000), (3, "b")]
    odd = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'c' AS label", "1 AS score")
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality_model.report(odd, none).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    scored = quality_model.report(odd, labels).collect()
    assert len(scored) == 5 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality_model.report(odd.limit(0), labels).collect() == []


def test_dual_descent_meets_its_conditions():
    rng = np.random.default_rng(3)
    rows, signs = [], np.where(rng.random(200) < 0.5, 1.0, -1.0)
    for s in signs:
        values = rng.normal(size=5) + s * 0.4
        rows.append((np.arange(5), values))
    weights, bias = quality_model.dual_descent(rows, signs, 5, epochs=400)
    x = np.array([v for _, v in rows])

    def primal(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * (x @ w + b)).sum()

    best = primal(weights, bias)
    for _ in range(300):
        assert best <= primal(weights + rng.normal(size=5) * 0.05, bias + rng.normal() * 0.05) + 1e-6
