"""Hard negatives by exact inner products, with candidates pruned by length and coordinates.

Rows are range-partitioned by label and length into buckets. An anchor is sent to the buckets
that may hold one of its partners: those of a fitting label whose longest row, times its own
length, reaches the score it already has from a first bucket. Inside a bucket every coordinate
has a sorted list of the rows' unit vectors. The score to reach is an angle to the anchor at
most, and so a range of values of each coordinate; the rows in the ranges of the anchor's
largest coordinates are the candidates, whose exact scores are then taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

BUCKET_ROWS = 4096
FOCUS = 3
EXACT = 1 << 53  # doubles hold all whole numbers below
LONGEST = (1 << 63) - 1
UNKNOWN = -LONGEST - 1  # no score is below it
SLACK = 1e-9  # of a cosine; far over the rounding of 64-bit arithmetic on unit vectors
NO_LONGS = "CAST(array() AS array<bigint>)"
TASK_ROW = "is_anchor boolean, bucket int, id bigint, label bigint, vector array<bigint>, floor bigint, scores array<bigint>, floors array<bigint>"
COLUMNS = ["is_anchor", "bucket", "id", "label", "vector", "floor", "scores", "floors"]


def usable(embeddings: DataFrame, scale: int = 256, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, label and whole-number vector of the rows that take part, one per id.

    Rows with a null id, label or vector, or a component that is null or not finite, are left
    out. Of rows with the same id the one with the smallest label, then vector, stays.
    """
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = embeddings.where(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("vector"),
    )
    if rows.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return rows
    return rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row")).select("id", "row.*")


def bucketed(rows: DataFrame, bucket_rows: int) -> tuple[DataFrame, DataFrame, int]:
    """The rows with their bucket, one row per bucket with its labels and longest length, and the number of buckets."""
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sized = rows.withColumn("length", F.sqrt(squares))
    parts = max(-(-rows.count() // bucket_rows), 1)
    dealt = sized.repartitionByRange(parts, "label", "length", "id").withColumn("bucket", F.spark_partition_id())
    pinned = stored(dealt, "vector-buckets")
    buckets = stored(pinned.groupBy("bucket").agg(
        F.min("label").alias("low_label"), F.max("label").alias("high_label"), F.max("length").alias("longest"),
    ), "buckets")
    return pinned, buckets, (buckets.agg(F.max("bucket")).first()[0] or 0) + 1


class Bucket:
    """The rows of a bucket, with a sorted list of the unit vectors' values per coordinate."""

    def __init__(self, ids, labels, vectors):
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, np.int64)
        width = max(map(len, vectors), default=0)
        self.vectors = np.zeros((len(vectors), width), np.int64)
        for i, v in enumerate(vectors):
            self.vectors[i, :len(v)] = v
        self.floats = self.vectors.astype(np.float64)
        self.peak = float(np.abs(self.floats).max(initial=0))
        lengths = np.sqrt((self.floats ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        self.units = np.divide(self.floats, lengths[:, None], out=np.zeros_like(self.floats), where=lengths[:, None] > 0)
        self.order = np.argsort(self.units, axis=0, kind="stable")
        self.lists = np.take_along_axis(self.units, self.order, axis=0)

    def candidates(self, anchor: np.ndarray, floor: int, focus: int) -> np.ndarray | None:
        """Rows that may score ``floor`` or more; None stands for all rows."""
        size = float(np.sqrt((anchor ** 2).sum()))
        if floor <= 0 or not self.longest:
            return None
        reach = floor / (size * self.longest) - SLACK if size else 2.0
        if reach > 1:
            return np.zeros(0, np.int64)
        if reach <= 0:
            return None
        unit = np.zeros(self.units.shape[1])
        unit[:min(len(anchor), len(unit))] = anchor[:len(unit)] / size
        angle = np.arccos(reach)
        hits = np.zeros(len(self.ids), np.int64)
        coordinates = np.argsort(-np.abs(unit), kind="stable")[:focus]
        for f in coordinates:
            own = np.arccos(np.clip(unit[f], -1, 1))
            low, high = np.cos(min(own + angle, np.pi)) - SLACK, np.cos(max(own - angle, 0.0)) + SLACK
            first = np.searchsorted(self.lists[:, f], low, "left")
            last = np.searchsorted(self.lists[:, f], high, "right")
            hits[self.order[first:last, f]] += 1
        return np.flatnonzero(hits == len(coordinates))

    def scores(self, anchor: list[int], rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products: in doubles where these are exact, else in Python's integers."""
        width = min(len(anchor), self.vectors.shape[1])
        top = max(map(abs, anchor), default=0)
        take = slice(None) if rows is None or 2 * len(rows) > len(self.ids) else rows
        if self.peak * float(top) * max(width, 1) < EXACT / 128:
            found = self.floats[take, :width] @ np.array(anchor[:width], np.float64)
            found = np.rint(found).astype(np.int64)
        else:
            wide = self.vectors[take, :width].astype(object)
            found = (wide * np.array(anchor[:width], object)).sum(axis=1) if width else np.zeros(len(wide), np.int64)
        return found if rows is None or not isinstance(take, slice) else found[rows]


def first_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k rows with the highest scores, ties by id."""
    if len(ids) > 4 * k:
        bar = np.partition(scores, len(ids) - k)[len(ids) - k]
        near = np.flatnonzero(scores >= bar)
        return near[first_rows(ids[near], scores[near], k)] if len(near) < len(ids) else near[np.lexsort((ids, -scores))[:k]]
    return np.lexsort((ids, -scores))[:k]


def long(value) -> int:
    return int(min(max(value, UNKNOWN), LONGEST))


def searched(tasks: DataFrame, search, schema: str) -> DataFrame:
    """Applies ``search(bucket, anchor row)`` to every anchor behind the rows of its bucket.

    A task holds the rows of one bucket at a time; anchors pass by in Arrow batches.
    """
    dealt = tasks.select(*COLUMNS).repartition("bucket").sortWithinPartitions("bucket", "is_anchor")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_bucket, held, bucket = None, [], None
        for batch in batches:
            made = []
            for row in zip(*[batch[c] for c in COLUMNS]):
                if row[1] != open_bucket:
                    open_bucket, held, bucket = row[1], [], None
                if not row[0]:
                    held.append(row[2:5])
                elif held:
                    if bucket is None:
                        bucket = Bucket(*zip(*held))
                    made += search(bucket, row)
            yield pd.DataFrame(made, columns=names)

    return dealt.mapInPandas(run, schema)


def same_label(k: int, focus: int):
    """Search for the k best rows of the anchor's label."""

    def search(bucket: Bucket, row: tuple) -> list[tuple]:
        anchor, label = [int(x) for x in row[4]], row[3]
        near = bucket.candidates(np.array(anchor, np.float64), int(row[5]), focus)
        ids, labels = (bucket.ids, bucket.labels) if near is None else (bucket.ids[near], bucket.labels[near])
        fit = np.flatnonzero((labels == label) & (ids != row[2]))
        if not len(fit):
            return []
        scores = bucket.scores(anchor, fit if near is None else near[fit])
        return [(row[2], int(ids[fit[i]]), long(scores[i])) for i in first_rows(ids[fit], scores, k)]

    return search


def in_windows(k: int, low: int, high: int, focus: int):
    """Search for the k best rows of other labels in the window of each positive score."""

    def search(bucket: Bucket, row: tuple) -> list[tuple]:
        anchor, label = [int(x) for x in row[4]], row[3]
        wanted = [int(s) for s in row[6]]
        floors = [int(f) for f in row[7]] or [UNKNOWN] * len(wanted)
        least = [max(-(-low * s // 100), f) for s, f in zip(wanted, floors)]
        open_ = [i for i, s in enumerate(wanted) if s >= 0]
        if not open_:
            return []
        near = bucket.candidates(np.array(anchor, np.float64), min(least[i] for i in open_), focus)
        ids, labels = (bucket.ids, bucket.labels) if near is None else (bucket.ids[near], bucket.labels[near])
        fit = np.flatnonzero(labels != label)
        if not len(fit):
            return []
        ids, scores = ids[fit], bucket.scores(anchor, fit if near is None else near[fit])
        made = []
        for i in open_:
            inside = np.flatnonzero((scores >= least[i]) & (scores <= high * wanted[i] // 100))
            for j in first_rows(ids[inside], scores[inside], k) if len(inside) else ():
                made.append((row[2], i, int(ids[inside[j]]), long(scores[inside[j]])))
        return made

    return search


def sent(anchors: DataFrame, buckets: DataFrame, count: int, wanted: Column) -> DataFrame:
    """A row per anchor and bucket that ``wanted`` keeps; there is one small row per bucket to compare with."""
    spread = anchors.drop("bucket").withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    return spread.join(F.broadcast(buckets), "bucket").where(wanted)


def mine(
    embeddings: DataFrame, is_anchor: Column, relabel: Column | None = None, positives: int = 5, negatives: int = 10,
    low: int = 30, high: int = 90, scale: int = 256, focus: int = FOCUS, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``is_anchor`` is a condition on id, label; ``relabel`` a label in place of the given one.
    Components are floor(scale * x). An anchor's positives are its ``positives`` best other rows
    of the same label; for each, the ``negatives`` best rows of other labels with a score of
    ``low`` to ``high`` hundredths of the positive's. Ties go to the smaller id.

    Defined results: see ``usable`` for nulls and repeated ids; a shorter vector counts as
    filled up with zeros; scores beyond 64 bits are ranked within a task exactly and returned
    as the largest long. A negative positive score has no window. No rows give no rows.
    Texts do not occur, other columns are not read.
    """
    rows = usable(embeddings, scale)
    if relabel is not None:
        rows = rows.withColumn("label", relabel)
    pinned, buckets, count = bucketed(rows, bucket_rows)
    none, longs = F.lit(UNKNOWN).cast("bigint"), F.expr(NO_LONGS)
    held = pinned.select(
        F.lit(False).alias("is_anchor"), "bucket", "id", "label", "vector", none.alias("floor"), longs.alias("scores"), longs.alias("floors")
    )
    anchors = pinned.where(is_anchor).select(
        F.lit(True).alias("is_anchor"), "bucket", "id", "label", "vector", "length", none.alias("floor"), longs.alias("scores"), longs.alias("floors")
    )

    def after(task_rows: DataFrame, search, schema: str) -> DataFrame:
        return searched(held.unionByName(task_rows.select(*COLUMNS)), search, schema)

    pairs = "anchor_id bigint, other_id bigint, score bigint"
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    own = after(anchors, same_label(positives, focus), pairs)
    floors = own.groupBy(F.col("anchor_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("best")).where(F.col("n") >= positives)
    bounded = stored(
        anchors.drop("floor").join(floors.select("id", F.col("best").alias("floor")), "id", "left").fillna({"floor": UNKNOWN}),
        "anchors-with-floor",
    )
    reaches = (F.col("floor") <= 0) | (F.col("length") * F.col("longest") * (1 + SLACK) >= F.col("floor"))
    fits = F.col("label").between(F.col("low_label"), F.col("high_label"))
    found = after(sent(bounded, buckets, count, reaches & fits), same_label(positives, focus), pairs)
    chosen = stored(
        found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "positives"
    )

    scores = F.array_sort(F.collect_list(F.struct("place", "score")))  # at most `positives` per anchor
    windows = chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.transform(scores, lambda s: s["score"]).alias("scores"))
    open_windows = stored(bounded.drop("scores").join(windows, "id"), "anchors-with-windows")
    results = "anchor_id bigint, window int, negative_id bigint, negative_score bigint"
    away = open_windows.withColumn("bucket", ((F.col("bucket") + count // 2) % count).cast("int"))
    seed = after(away, in_windows(negatives, low, high, focus), results)
    bars = seed.groupBy("anchor_id", "window").agg(F.count("*").alias("n"), F.min("negative_score").alias("bar")).where(F.col("n") >= negatives)
    by_anchor = bars.groupBy(F.col("anchor_id").alias("id")).agg(F.map_from_entries(F.collect_list(F.struct("window", "bar"))).alias("bars"))
    least = F.transform("scores", lambda s, i: F.greatest(
        F.coalesce(F.try_element_at("bars", i), F.lit(UNKNOWN)), F.ceil(F.lit(low) * s.cast("decimal(20,0)") / 100).cast("bigint")
    ))
    armed = open_windows.drop("floors").join(by_anchor, "id", "left").withColumn("floors", least).drop("bars")
    weakest = F.array_min(F.transform(F.arrays_zip("scores", "floors"), lambda z: F.when(z["scores"] >= 0, z["floors"])))
    reaches = (weakest <= 0) | (F.col("length") * F.col("longest") * (1 + SLACK) >= weakest)
    others = (F.col("low_label") != F.col("label")) | (F.col("high_label") != F.col("label"))
    found = after(sent(stored(armed, "anchors-with-floors"), buckets, count, reaches & others), in_windows(negatives, low, high, focus), results)
    hardest = Window.partitionBy("anchor_id", "window").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
    partner = chosen.select("anchor_id", (F.col("place") - 1).alias("window"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(partner, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def report(embeddings: DataFrame) -> DataFrame:
    """Negatives of the rows with an id divisible by 100, after every seventh label is moved on."""
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(embeddings, F.col("id") % 100 == 0, moved)


SQL = """
WITH rows AS (
    SELECT vec_id AS id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor_id, o.id AS other_id, a.label = o.label AS alike,
           list_inner_product(a.v, o.v)::BIGINT AS score
    FROM rows a JOIN rows o ON a.id % 100 = 0 AND a.id <> o.id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id)::INTEGER AS rank,
       n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
     AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
