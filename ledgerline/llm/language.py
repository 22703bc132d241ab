"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies are counted over all labelled training rows. The weights are fitted on
a bounded sample of them (``fit_rows``, shared evenly among the languages) by follow the
regularised leader with elastic-net penalties: each shard of the sample makes its own pass
in a task and the shards' weights are averaged. One temperature, fitted on a part of the
sample that the weights have not seen, turns the scores into calibrated probabilities.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Rows without
a label or without an id are not learned from, but are predicted. Without any training row
every text is ``und``. Repeated rows count as often as they occur. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import ngrams
from ledgerline.llm.common import stored

UNKNOWN = "und"
FIT_ROWS = 8000
SHARDS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.5
CALIBRATION_SHARE = 0.15


@dataclass
class LanguageModel:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # bucket x label
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, text: str) -> np.ndarray:
        return unit_vector(text, self.idf) @ self.weights + self.bias


def unit_vector(text: str, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of a text, scaled to length one."""
    values = ngrams.counts(text.lower()).astype(np.float32) * idf
    length = float(np.sqrt(values @ values))
    return values / length if length else values


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return shifted / shifted.sum(axis=-1, keepdims=True)


def ftrl_fit(vectors: list[tuple[np.ndarray, np.ndarray]], kinds: np.ndarray, classes: int, seed: int = 0,
             epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias of one shard; ``vectors`` are (buckets, values) of its texts."""
    z, n = np.zeros((ngrams.SIZE, classes)), np.zeros((ngrams.SIZE, classes))
    bias, bias_n = np.zeros(classes), np.zeros(classes)
    order = np.random.default_rng(seed)

    def active(z, n):
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            used, values = vectors[i]
            own_z, own_n = z[used], n[used]
            weights = active(own_z, own_n)
            error = softmax(values @ weights + bias)
            error[kinds[i]] -= 1
            gradient = values[:, None] * error
            squared = gradient * gradient
            step = (np.sqrt(own_n + squared) - np.sqrt(own_n)) / ALPHA
            z[used] = own_z + gradient - step * weights
            n[used] = own_n + squared
            bias_n += error * error
            bias -= ALPHA * error / (BETA + np.sqrt(bias_n))
    return active(z, n), bias


def best_temperature(logits: np.ndarray, kinds: np.ndarray) -> float:
    """The temperature of the smallest log loss, by golden-section search on its logarithm."""
    def loss(log_t):
        chosen = softmax(logits / np.exp(log_t))[np.arange(len(kinds)), kinds]
        return -np.log(np.maximum(chosen, 1e-12)).mean()

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def sample_share(rows: DataFrame, label: str, per_label: int, seed: int) -> tuple[list, Column]:
    """The labels, and a filter that keeps about ``per_label`` rows of each by a hash of their ids."""
    sizes = {r[label]: r["count"] for r in rows.groupBy(label).count().collect()}
    labels = sorted(sizes)
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for value in labels:
        keep = F.when(F.col(label) == value, place < per_label / sizes[value]).otherwise(keep)
    return labels, keep


def train(rows: DataFrame, fit_rows: int = FIT_ROWS, shards: int = SHARDS) -> LanguageModel:
    """A model from training rows (doc_id, text, lang)."""
    spark = rows.sparkSession
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang")
    found = rows.select("lang").distinct().count()
    labels, keep = sample_share(rows, "lang", max(fit_rows // max(found, 1), 1), 1)
    if not labels:
        return LanguageModel([], np.zeros(ngrams.SIZE, np.float32), np.zeros((ngrams.SIZE, 0)), np.zeros(0))
    seen = ngrams.document_frequencies(rows.select("text", F.lit(0).alias("class")))[0]
    total = rows.count()
    idf = np.log((1 + total) / (1 + seen)).astype(np.float32) + np.float32(1)
    shared = spark.sparkContext.broadcast(idf)
    place = F.pmod(F.xxhash64(F.lit(2), "doc_id"), F.lit(1000))
    sample = stored(
        rows.where(keep).withColumn("_shard", F.when(place < 1000 * CALIBRATION_SHARE, -1).otherwise(place % shards)), "language-sample"
    )

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "text"])
        vectors = []
        for text in part["text"]:
            dense = unit_vector(text, shared.value)
            used = np.flatnonzero(dense)
            vectors.append((used, dense[used].astype(np.float64)))
        kinds = part["lang"].map(labels.index).to_numpy()
        weights, bias = ftrl_fit(vectors, kinds, len(labels), seed=int(part["_shard"].iloc[0]))
        at, kind = np.nonzero(weights)
        return pd.concat([
            pd.DataFrame({"bucket": at, "kind": kind, "weight": weights[at, kind]}),
            pd.DataFrame({"bucket": -1, "kind": range(len(labels)), "weight": bias}),
        ])

    fitted = sample.where("_shard >= 0").groupBy("_shard").applyInPandas(fit, "bucket int, kind int, weight double")
    used_shards = max(sample.where("_shard >= 0").select("_shard").distinct().count(), 1)
    weights, bias = np.zeros((ngrams.SIZE, len(labels)), np.float32), np.zeros(len(labels))
    for row in fitted.groupBy("bucket", "kind").agg(F.sum("weight").alias("weight")).collect():
        target = bias if row["bucket"] < 0 else weights[row["bucket"]]
        target[row["kind"]] = row["weight"] / used_shards
    model = LanguageModel(labels, idf, weights, bias.astype(np.float32))
    check = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            logits = [check.value.logits(t).astype(float).tolist() for t in batch["text"]]
            yield pd.DataFrame({"kind": batch["lang"].map(labels.index), "logits": logits})

    rest = sample.where("_shard = -1").mapInPandas(score, "kind int, logits array<double>").collect()
    if rest:
        model.temperature = best_temperature(np.array([r["logits"] for r in rest]), np.array([r["kind"] for r in rest]))
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of rows (doc_id, held_out, text); only texts are looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for batch in batches:
            names, scores = [], []
            for text in batch["text"]:
                if not own.labels or not has_letter(text):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                chances = softmax(own.logits(text).astype(float) / own.temperature)
                best = int(chances.argmax())
                names.append(own.labels[best])
                scores.append(float(chances[best]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": names, "score": scores})

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text")
    return narrow.mapInPandas(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def fold(parts: int) -> Column:
    """crc32 of the id's text, modulo the parts; null for rows without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def report(docs: DataFrame) -> DataFrame:
    """Learns from documents outside fold 1 of 3 and predicts all of them."""
    folded = docs.select("doc_id", "text", "lang", fold(3).alias("_fold"))
    model = train(folded.where("_fold <> 1"))
    return predict(folded.select("doc_id", "text", F.coalesce(F.col("_fold") == 1, F.lit(False)).alias("held_out")), model)
