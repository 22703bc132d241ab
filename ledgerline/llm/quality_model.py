"""Quality classifier: naive Bayes log-count ratios scale n-gram flags for a linear hinge-loss model.

The ratios come from counts over all labelled training rows. The linear model is fitted on a
bounded sample of them (``fit_rows``, half of it for each label) by dual coordinate descent:
each shard of the sample is solved in its own task, and the shards' weights are averaged. A
logistic curve, fitted on a part of the sample that the weights have not seen and weighted
back to the labels' true shares, turns margins into scores.

Defined results: null and empty texts have no n-gram and get the score of the intercept.
Documents without an id are scored but not learned from. Of several labels of one document
the largest counts; null labels do not. With fewer than two labels in the training rows
every score is the share of label 1 (one half without any). Repeated rows are scored each.
Texts are read whole; labels, language, source and id never enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import ngrams
from ledgerline.llm.common import join_few, stored
from ledgerline.llm.language import fold, sample_share

FIT_ROWS = 8000
SHARDS = 4
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
CALIBRATION_SHARE = 0.25
THRESHOLD = 0.7


@dataclass
class QualityModel:
    weights: np.ndarray  # per bucket, with the ratio multiplied in
    bias: float
    slope: float
    offset: float

    def margin(self, text: str | None) -> float:
        flags = ngrams.present(text or "", np.zeros(ngrams.SIZE, bool))
        size = np.count_nonzero(flags)
        return float(self.weights[flags].sum() / np.sqrt(size) + self.bias) if size else self.bias

    def score(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -40, 40)))


def log_ratios(counts: np.ndarray) -> np.ndarray:
    """Logarithm of the ratio of smoothed class frequencies, label 1 over label 0."""
    smoothed = counts + SMOOTHING
    shares = smoothed / smoothed.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, seed: int = 0,
                 cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and intercept of the linear hinge-loss model; rows are (places, values).

    The intercept is the weight of a constant one. Each step solves one dual variable,
    which stays between 0 and ``cost``.
    """
    weights, bias = np.zeros(size), 0.0
    alphas = np.zeros(len(rows))
    norms = np.array([values @ values + 1.0 for _, values in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            used, values = rows[i]
            gradient = signs[i] * (weights[used] @ values + bias) - 1
            new = min(max(alphas[i] - gradient / norms[i], 0.0), cost)
            if new != alphas[i]:
                change = (new - alphas[i]) * signs[i]
                weights[used] += change * values
                bias += change
                alphas[i] = new
    return weights, bias


def logistic_curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression on one number, by Newton steps."""
    slope, offset = 1.0, 0.0
    total = weights.sum()
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -40, 40)))
        error, spread = weights * (chance - labels), weights * chance * (1 - chance)
        gradient = np.array([error @ margins + 1e-3 * total * slope * 1e-2, error.sum()])
        hessian = np.array([[spread @ (margins * margins) + 1e-5 * total, spread @ margins], [spread @ margins, spread.sum() + 1e-9]])
        step = np.linalg.solve(hessian, gradient)
        scale = min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        slope, offset = slope - scale * step[0], offset - scale * step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, shards: int = SHARDS) -> QualityModel:
    """A model from documents (doc_id, text) and training labels (doc_id, label 0 or 1)."""
    spark = docs.sparkSession
    known = stored(
        labels.where("doc_id IS NOT NULL AND label IN (0, 1)").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max(F.col("label").cast("int")).alias("label")),
        "labels",
    )
    rows = join_few(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")),
        known, ["doc_id"], row_bytes=24, how="inner", salts=1,
    )
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    total = sum(sizes.values())
    if len(sizes) < 2:
        share = sizes.get(1, 0) / total if total else 0.5
        limit = float(np.clip(share, 1e-9, 1 - 1e-9))
        return QualityModel(np.zeros(ngrams.SIZE), 0.0, 0.0, float(np.log(limit / (1 - limit))))
    ratios = log_ratios(ngrams.document_frequencies(rows.select("text", F.col("label").alias("class")), 2, lower=False))
    shared = spark.sparkContext.broadcast(ratios)
    _, keep = sample_share(rows, "label", max(fit_rows // 2, 1), 3)
    place = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1000))
    sample = stored(
        rows.where(keep).withColumn("_shard", F.when(place < 1000 * CALIBRATION_SHARE, -1).otherwise(place % shards)), "quality-sample"
    )

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "text"])
        vectors = []
        for text in part["text"]:
            used = np.flatnonzero(ngrams.present(text, np.zeros(ngrams.SIZE, bool)))
            vectors.append((used, shared.value[used] / np.sqrt(max(len(used), 1))))
        signs = np.where(part["label"].to_numpy() == 1, 1.0, -1.0)
        weights, bias = dual_descent(vectors, signs, ngrams.SIZE, seed=int(part["_shard"].iloc[0]))
        at = np.flatnonzero(weights)
        return pd.DataFrame({"bucket": [*at, -1], "weight": [*weights[at], bias]})

    fitted = sample.where("_shard >= 0").groupBy("_shard").applyInPandas(fit, "bucket int, weight double")
    used_shards = max(sample.where("_shard >= 0").select("_shard").distinct().count(), 1)
    weights, bias = np.zeros(ngrams.SIZE), 0.0
    for row in fitted.groupBy("bucket").agg(F.sum("weight").alias("weight")).collect():
        if row["bucket"] < 0:
            bias = row["weight"] / used_shards
        else:
            weights[row["bucket"]] = row["weight"] / used_shards
    model = QualityModel((weights * ratios).astype(np.float32), bias, 1.0, 0.0)
    check = spark.sparkContext.broadcast(model)

    def margins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "margin": [check.value.margin(t) for t in batch["text"]]})

    rest = sample.where("_shard = -1").mapInPandas(margins, "label int, margin double").toPandas()
    seen = rest["label"].value_counts()
    if len(seen) == 2:
        shares = rest["label"].map({k: sizes[k] / seen[k] for k in seen.index}).to_numpy(float)
        model.slope, model.offset = logistic_curve(rest["margin"].to_numpy(), rest["label"].to_numpy(float), shares / shares.mean())
    return model


def predict(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of rows (doc_id, held_out, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            scores = own.score(np.array([own.margin(t) for t in batch["text"]], dtype=float))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "score": scores,
                                "predicted": (scores >= threshold).astype("int32")})

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text")
    return narrow.mapInPandas(run, "doc_id bigint, held_out boolean, score double, predicted int")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns from labels outside fold 2 of 4 and scores all documents."""
    training = labels.select("doc_id", F.col("quality").alias("label")).where(fold(4) != 2)
    model = train(docs.where(fold(4) != 2), training)
    return predict(docs.select("doc_id", "text", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out")), model)
