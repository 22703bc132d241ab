"""Forests whose trees answer several targets at once.

Rows become blocks of binned features and targets. A tree grows from the top by histograms:
tasks sum the targets per (node, feature, bin), the sums of a node merge in one place, and the
split with the largest reduction of the summed variances of all targets is kept there; the
driver sees splits only. Once a node holds few enough rows, these are brought together and one
task grows the rest of its subtree level by level: by sums per (node, bin) while these cells are
few for the rows, over sorted rows below. All ways look at the same cuts, so where one ends and
the other begins does not change the tree. Rows are brought together for a few trees at a time,
in files of the shared folder (see ``sources.blobs``) that are removed before the next trees.

Rows are drawn with Poisson weights from a hash of row and tree, so a repeated task draws the
same rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.encoders import _TableModel
from ledgerline.session import scratch_path, use_checkpoints
from ledgerline.sources.blobs import opened, qualified, remove, written

MAX_BINS = 256
LOCAL_ROWS = 1 << 19  # rows of a node whose subtree one task grows
BLOCK_ROWS = 1 << 16  # rows of a block, at least, where there are so many in a task
CELLS = 4  # sums per row, beyond which rows are sorted instead
HISTOGRAM_BYTES = 64 << 20  # sums of one pass over the rows, per task
DEALT_BYTES = 1 << 30  # drawn rows that are brought together at a time, or one tree's
RUN_BYTES = 32 << 20  # drawn rows of a task that are sorted by node and written at a time
SENT_BYTES = 256 << 20  # trees broadcast at once
LEAST_GAIN = 1e-12  # of the squares at the root
POISSON = np.cumsum([np.exp(-1) / np.prod(range(1, k + 1), dtype=np.float64) for k in range(18)])
BLOCK = "size int, bins binary, answers binary, keys binary"


# Rows ----------------------------------------------------------------------------------


def bin_edges(vectors: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Upper ends of the bins of each place of the vector.

    Codes have a bin each as far as ``max_bins`` allows; measures are cut at quantiles from a
    mergeable sketch of all rows.
    """
    described = vectors.schema[features].metadata.get("ml_attr", {})
    width = described.get("num_attrs") or len(vectors.select(features).first()[0])
    codes = {a["idx"]: len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in described.get("attrs", {}).get("nominal", [])}
    edges: dict[int, np.ndarray] = {i: np.arange(-1, n) + 0.5 for i, n in codes.items() if 0 < n < max_bins - 1}
    rest = [i for i in range(width) if i not in edges]
    shares = [k / max_bins for k in range(1, max_bins)]
    if rest:
        array = vectors.select(vector_to_array(features).alias("v"))
        row = array.agg(*[F.percentile_approx(F.get("v", F.lit(i)), shares, 10_000).alias(f"q{i}") for i in rest]).first()
        edges |= {i: np.unique(np.array(row[f"q{i}"] or [], np.float64)) for i in rest}
    return [edges[i] for i in range(width)]


def into_bins(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of edges below it."""
    out = np.empty(values.shape, np.uint16)
    for i, cuts in enumerate(edges):
        out[:, i] = np.searchsorted(cuts, values[:, i], "left")
    return out


def bin_type(bins_count: int) -> type:
    return np.uint8 if bins_count <= 256 else np.uint16


def blocks_of(vectors: DataFrame, features: str, answers: Sequence[str], edges: Sequence[np.ndarray]) -> DataFrame:
    """Checkpointed blocks of rows: bins, answers and a key per row, as bytes."""
    use_checkpoints(vectors.sparkSession)
    rows = vectors.select(
        vector_to_array(features).alias("v"), F.monotonically_increasing_id().alias("key"),
        *[F.col(a).cast("double").alias(f"y{i}") for i, a in enumerate(answers)],
    )

    kind = bin_type(max((len(e) for e in edges), default=0) + 1)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            bins = into_bins(np.array(batch["v"].tolist(), np.float64).reshape(len(batch), len(edges)), edges).astype(kind)
            held.append((bins, batch[[f"y{i}" for i in range(len(answers))]].to_numpy(np.float64), batch["key"].to_numpy(np.uint64)))
            if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                yield block(held)
                held = []
        if sum(len(h[0]) for h in held):
            yield block(held)

    def block(held: list[tuple]) -> pd.DataFrame:
        bins, y, keys = (np.concatenate(c) for c in zip(*held))
        return pd.DataFrame({"size": [len(keys)], "bins": [bins.tobytes()], "answers": [y.tobytes()], "keys": [keys.tobytes()]})

    return rows.mapInPandas(pack, BLOCK).checkpoint().persist(StorageLevel.MEMORY_AND_DISK)


def unpacked(batches: Iterator[pd.DataFrame], shape: tuple):
    for batch in batches:
        yield from unpacked_rows(zip(batch["size"], batch["bins"], batch["answers"], batch["keys"]), shape)


def unpacked_rows(rows: Iterator[tuple], shape: tuple):
    features, bins_count, answers = shape
    for size, bins, y, keys in rows:
        yield (np.frombuffer(bins, bin_type(bins_count)).reshape(size, features), np.frombuffer(y, np.float64).reshape(size, answers),
               np.frombuffer(keys, np.uint64))


def drawn(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Poisson weights with mean one, from a mixed hash of key, tree and seed."""
    with np.errstate(over="ignore"):
        x = keys + np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x ^= x >> np.uint64(31)
    return np.searchsorted(POISSON, (x >> np.uint64(11)) / float(1 << 53), "right").astype(np.float64)


# Trees ---------------------------------------------------------------------------------


class Tree:
    """Nodes in lists; children are places in them, 0 where there is none."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def add(self, value: np.ndarray) -> int:
        for column, item in ((self.feature, 0), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, value)):
            column.append(item)
        return len(self.feature) - 1

    def arrays(self) -> tuple:
        return tuple(np.array(c, t) for c, t in ((self.feature, np.uint16), (self.cut, np.uint16), (self.left, np.int32), (self.right, np.int32))) + (
            np.array(self.value, np.float64).reshape(len(self.feature), -1),)


def landed(bins: np.ndarray, arrays: tuple) -> np.ndarray:
    """Node at which each row ends."""
    feature, cut, left, right, _ = arrays
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows):
        at = node[rows]
        inner = left[at] > 0
        rows, at = rows[inner], at[inner]
        node[rows] = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
    return node


def cuts_of_cells(column: np.ndarray, width: int, weighted: np.ndarray, weights: np.ndarray, node: np.ndarray, sizes: np.ndarray, min_leaf: float):
    """Node, bin, rows and summed targets to the left of every cut, from sums per (node, bin)."""
    count = len(sizes)
    cell = node * width + column
    own = np.bincount(cell, weights, count * width).reshape(count, width)
    above = np.cumsum(own, axis=1)
    fits = np.flatnonzero((own > 0) & (above >= min_leaf) & (sizes[:, None] - above >= min_leaf))
    if not len(fits):
        return None
    left = [np.cumsum(np.bincount(cell, c, count * width).reshape(count, width), axis=1).ravel()[fits] for c in weighted]
    return fits // width, fits % width, above.ravel()[fits], left


def cuts_of_order(column: np.ndarray, weighted: np.ndarray, weights: np.ndarray, node: np.ndarray, sizes: np.ndarray, min_leaf: float):
    """The same over rows sorted by (node, bin)."""
    narrow = node.astype(np.uint16) if len(sizes) < 1 << 16 else node  # 16-bit keys are sorted by radix
    order = np.argsort(column, kind="stable")
    order = order[np.argsort(narrow[order], kind="stable")]
    own, at = column[order], node[order]
    ends = np.flatnonzero((own[1:] != own[:-1]) & (at[1:] == at[:-1]))
    first = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(sizes)))])[at[ends]]

    def before(values: np.ndarray) -> np.ndarray:
        above = np.cumsum(values[order])
        return above[ends] - np.where(first > 0, above[first - 1], 0.0)

    n_left = before(weights)
    fits = np.flatnonzero((n_left >= min_leaf) & (sizes[at[ends]] - n_left >= min_leaf))
    if not len(fits):
        return None
    return at[ends][fits], own[ends][fits], n_left[fits], [before(c)[fits] for c in weighted]


def best_cuts(columns: np.ndarray, weighted: np.ndarray, weights: np.ndarray, node: np.ndarray, sizes: np.ndarray, sums: np.ndarray, min_leaf: float):
    """Per node the gain, feature and bin of its best split; ``columns`` and ``weighted`` have a line per feature and target."""
    count = len(sizes)
    best, feature, cut = np.zeros(count), np.zeros(count, np.int64), np.zeros(count, np.int64)
    whole = (sums ** 2).sum(axis=1) / np.maximum(sizes, 1e-300)
    for f, column in enumerate(columns):
        width = int(column.max()) + 1
        if count * width <= CELLS * len(node):
            found = cuts_of_cells(column, width, weighted, weights, node, sizes, min_leaf)
        else:
            found = cuts_of_order(column, weighted, weights, node, sizes, min_leaf)
        if found is None:
            continue
        at, place, n_left, lefts = found
        n_right = sizes[at] - n_left
        gain = -whole[at]
        for left, totals in zip(lefts, sums.T):
            gain += left * left / n_left + (totals[at] - left) ** 2 / n_right
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        top = np.maximum.reduceat(gain, edge)
        leading = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(edge, len(at)))))
        winners = leading[np.unique(at[leading], return_index=True)[1]]
        better = winners[gain[winners] > best[at[winners]] * (1 + 1e-9)]
        best[at[better]], feature[at[better]], cut[at[better]] = gain[better], f, place[better]
    return best, feature, cut


def grown(bins: np.ndarray, y: np.ndarray, weights: np.ndarray, depth: int, min_leaf: float, least: float) -> Tree:
    """A whole subtree over rows in memory, level by level."""
    kept = weights > 0
    columns, weights = np.ascontiguousarray(bins[kept].T), weights[kept].astype(np.float64)
    weighted = np.ascontiguousarray((y[kept] * weights[:, None]).T)
    tree = Tree()
    min_leaf = max(min_leaf, 1e-9)
    level, node = [tree.add(np.zeros(len(weighted)))], np.zeros(len(weights), np.int64)

    def moved(to: np.ndarray) -> None:
        """Goes on with the rows that have a place."""
        nonlocal columns, weighted, weights, node
        stay = to >= 0
        if stay.all():
            node = to
        else:
            columns, weighted, weights, node = columns[:, stay], weighted[:, stay], weights[stay], to[stay]

    for at_depth in range(depth + 1):
        sizes = np.bincount(node, weights, len(level))
        sums = np.stack([np.bincount(node, c, len(level)) for c in weighted], axis=1)
        for own, value in zip(level, sums / np.maximum(sizes, 1e-300)[:, None]):
            tree.value[own] = value
        large = sizes >= 2 * min_leaf
        if at_depth == depth or not large.any():
            break
        if not large.all():
            moved(np.where(large, np.cumsum(large) - 1, -1)[node])
            level, sizes, sums = [n for n, goes_on in zip(level, large) if goes_on], sizes[large], sums[large]
        gain, feature, cut = best_cuts(columns, weighted, weights, node, sizes, sums, min_leaf)
        follow, places = [], np.full((len(level), 2), -1)
        for i in np.flatnonzero(gain > least):
            own = level[i]
            tree.feature[own], tree.cut[own] = int(feature[i]), int(cut[i])
            tree.left[own], tree.right[own] = tree.add(sums[i]), tree.add(sums[i])  # their own values follow
            places[i] = len(follow), len(follow) + 1
            follow += [tree.left[own], tree.right[own]]
        if not follow:
            break
        goes_right = columns[feature[node], np.arange(len(node))] > cut[node]
        moved(places[node, goes_right.view(np.int8)])
        level = follow
    return tree


# Growing over all rows -----------------------------------------------------------------


def split_of(table: np.ndarray, min_leaf: float) -> tuple | None:
    """Best split of a node from its sums per feature and bin: count first, then the targets."""
    table = table.transpose(0, 2, 1)
    totals = table[0].sum(axis=0)
    above = np.cumsum(table, axis=1)[:, :-1]
    n_left, n_right = above[..., 0], totals[0] - above[..., 0]
    fits = (n_left >= max(min_leaf, 1e-9)) & (n_right >= max(min_leaf, 1e-9)) & (table[:, :-1, 0] > 0)
    if not fits.any():
        return None
    left, right = above[..., 1:], totals[1:] - above[..., 1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left ** 2).sum(axis=2) / n_left + (right ** 2).sum(axis=2) / n_right - (totals[1:] ** 2).sum() / totals[0]
    gain[~fits] = -np.inf
    per_feature = gain.max(axis=1)
    best = 0
    for f in range(1, len(per_feature)):  # as over sorted rows: a later feature must be clearly better
        best = f if per_feature[f] > max(per_feature[best], 0) * (1 + 1e-9) else best
    cut = int(gain[best].argmax())
    return float(gain[best, cut]), best, cut, totals, above[best, cut]


def top_splits(blocks: DataFrame, trees: dict, wanted: Sequence[tuple], shape: tuple, seed: int, centre: np.ndarray, min_leaf: float, draw: bool) -> list:
    """The best split of each wanted (tree, node), from histograms that merge in one task per node."""
    features, bins_count, answers = shape
    sent = {t: trees[t].arrays() for t in {t for t, _ in wanted}}
    by_tree = {t: [n for u, n in wanted if u == t] for t in sent}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = {t: np.zeros((len(nodes), features, answers + 1, bins_count)) for t, nodes in by_tree.items()}
        for bins, y, keys in unpacked(batches, shape):
            columns, centred = np.ascontiguousarray(bins.T), np.ascontiguousarray((y - centre).T)
            for t, nodes in by_tree.items():
                weights = drawn(keys, t, seed) if draw else np.ones(len(keys))
                place = np.full(len(sent[t][0]), -1)
                place[nodes] = np.arange(len(nodes))
                at = place[landed(bins, sent[t])]
                rows = np.flatnonzero((at >= 0) & (weights > 0))
                start, w = at[rows] * bins_count, weights[rows]
                values = [w, *(c[rows] * w for c in centred)]
                for f in range(features):
                    cell = start + columns[f, rows]
                    for k, v in enumerate(values):
                        tables[t][:, f, k] += np.bincount(cell, v, len(nodes) * bins_count).reshape(-1, bins_count)
        for t, nodes in by_tree.items():
            yield pd.DataFrame([(t, n, table.tobytes()) for n, table in zip(nodes, tables[t])], columns=["tree", "node", "sums"])

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        table = sum(np.frombuffer(b, np.float64) for b in part["sums"]).reshape(features, answers + 1, bins_count)
        return pd.DataFrame({"tree": [part["tree"][0]], "node": [part["node"][0]], "split": [pickle.dumps(split_of(table, min_leaf))]})

    found = blocks.mapInPandas(count, "tree int, node int, sums binary").groupBy("tree", "node").applyInPandas(merge, "tree int, node int, split binary")
    return [(r["tree"], r["node"], pickle.loads(r["split"])) for r in found.collect()]


def grow_forest(blocks: DataFrame, shape: tuple, trees: int, depth: int, min_leaf: float, seed: int, centre: np.ndarray,
                rows: int, squares: float, draw: bool = True, local_rows: int = LOCAL_ROWS) -> DataFrame:
    """(tree, body): the arrays of every tree, as bytes."""
    features, bins_count, answers = shape
    least = LEAST_GAIN * squares
    tops = {t: Tree() for t in range(trees)}
    for tree in tops.values():
        tree.add(np.zeros(answers))
    level = {(t, 0): rows for t in range(trees)}
    at_depth, finish = 0, {}
    per_pass = max(HISTOGRAM_BYTES // (features * bins_count * (answers + 1) * 8), 1)
    while level:
        finish |= {place: depth - at_depth for place, n in level.items() if n <= local_rows}
        wanted = sorted(place for place, n in level.items() if n > local_rows and at_depth < depth)
        level = {}
        for start in range(0, len(wanted), per_pass):
            for t, n, split in top_splits(blocks, tops, wanted[start:start + per_pass], shape, seed, centre, min_leaf, draw):
                if split is None or split[0] <= least:
                    continue
                gain, feature, cut, totals, left = split
                tree = tops[t]
                tree.value[n] = totals[1:] / totals[0]
                tree.feature[n], tree.cut[n] = feature, cut
                right = totals - left
                tree.left[n], tree.right[n] = tree.add(left[1:] / left[0]), tree.add(right[1:] / right[0])
                level |= {(t, tree.left[n]): left[0], (t, tree.right[n]): right[0]}
        at_depth += 1
    each = (1 - np.exp(-1) if draw else 1) * rows * (features * np.dtype(bin_type(bins_count)).itemsize + 8 * answers + 1)
    group, made = max(int(DEALT_BYTES // each), 1), []
    for first in range(0, trees, group):
        some = {t: tops[t] for t in range(first, min(first + group, trees))}
        made.append(finished(blocks, some, {p: d for p, d in finish.items() if p[0] in some}, shape, seed, centre, min_leaf, least, draw))
    return reduce(DataFrame.unionByName, made)


def finished(blocks: DataFrame, tops: dict, finish: dict, shape: tuple, seed: int, centre: np.ndarray, min_leaf: float, least: float, draw: bool) -> DataFrame:
    """Grows the small nodes' subtrees, each in one task, and puts the trees together; checkpointed, its files are removed."""
    features, bins_count, answers = shape
    spark = blocks.sparkSession
    kind = bin_type(bins_count)
    sent = {t: tree.arrays() for t, tree in tops.items()}
    ends = {t: sorted(n for u, n in finish if u == t) for t in tops}
    first = dict(zip(ends, np.cumsum([0, *map(len, ends.values())]).tolist()))  # a tree's first among all nodes
    count = len(finish)
    widths = [features * np.dtype(kind).itemsize, answers * 8, 1]  # bytes of a row: bins, answers, weight
    folder = qualified(spark, scratch_path(spark, "forest"))

    def runs(packs: Iterator[tuple]) -> Iterator[tuple]:
        """Drawn rows sorted by their node: the nodes' ends, bins, answers and weights."""
        held, size = [], 0
        for bins, y, keys in unpacked_rows(packs, shape):
            y = y - centre
            for t, arrays in sent.items():
                place = np.full(len(arrays[0]), -1)
                place[ends[t]] = np.arange(len(ends[t])) + first[t]
                weights = drawn(keys, t, seed) if draw else np.ones(len(keys))
                at = np.where(weights > 0, place[landed(bins, arrays)], -1)
                rows = np.flatnonzero(at >= 0)
                held.append((at[rows], bins[rows], y[rows], weights[rows].astype(np.uint8)))
                size += len(rows) * (sum(widths) + 8)
                if size >= RUN_BYTES:
                    yield run(held)
                    held, size = [], 0
        if held:
            yield run(held)

    def run(held: list[tuple]) -> tuple:
        at, *columns = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(at.astype(np.int16) if count < 1 << 15 else at, kind="stable")
        return np.cumsum(np.bincount(at, minlength=count)), *[c[order] for c in columns]

    def deal(part: int, packs: Iterator[tuple]) -> Iterator[int]:
        with written(f"{folder}/rows-{part}") as out, written(f"{folder}/ends-{part}") as index:
            for upto, *columns in runs(packs):
                index.write(upto.astype(np.int64).tobytes())
                for c in columns:
                    out.write(np.ascontiguousarray(c))
        yield part

    def gathered(place: int, parts: Sequence[int]) -> list[np.ndarray]:
        """The bins, answers and weights of a node's rows."""
        made: list[list[bytes]] = [[b""], [b""], [b""]]
        for part in parts:
            with opened(f"{folder}/ends-{part}") as index, opened(f"{folder}/rows-{part}") as rows:
                start = 0
                for k in range(index.size() // (8 * count)):
                    upto = np.frombuffer(index.read_at(8 * count, 8 * count * k), np.int64)
                    low, high = int(upto[place - 1]) if place else 0, int(upto[place])
                    for own, width in zip(made, widths):
                        if high > low:
                            own.append(rows.read_at((high - low) * width, start + low * width))
                        start += int(upto[-1]) * width
        shapes = (kind, features), (np.float64, answers), (np.uint8, 0)
        return [np.frombuffer(b"".join(own), t).reshape(-1, *([n] if n else [])) for own, (t, n) in zip(made, shapes)]

    def grow(nodes: Iterator[tuple]) -> Iterator[int]:
        for t, n, depth, place in nodes:
            bins, y, weights = gathered(place, parts)
            with written(f"{folder}/below-{t}-{n}") as out:
                out.write(pickle.dumps(grown(bins, y, weights, depth, min_leaf, least).arrays()))
            yield n

    def join(t: int) -> tuple:
        below = {}
        for n in ends[t]:
            with opened(f"{folder}/below-{t}-{n}") as stream:
                below[n] = pickle.loads(stream.read())
        return t, pickle.dumps(grafted(sent[t], below))

    try:
        context = spark.sparkContext
        if count:
            # A few blocks at a time reach the task, where Arrow would send those of a whole partition.
            parts = sorted(blocks.select("size", "bins", "answers", "keys").rdd.mapPartitionsWithIndex(deal).collect())
            places = [(t, n, finish[t, n], first[t] + i) for t in ends for i, n in enumerate(ends[t])]
            slices = min(count, 8 * max(context.defaultParallelism, 1))
            dealt = [p for k in range(slices) for p in places[k::slices]]  # a tree's nodes go to different tasks
            context.parallelize(dealt, slices).mapPartitions(grow).count()
        bodies = context.parallelize(list(tops), len(tops)).map(join)
        return spark.createDataFrame(bodies, "tree int, body binary").checkpoint()
    finally:
        remove([folder])


def grafted(top: tuple, subtrees: dict[int, tuple]) -> tuple:
    """A tree's arrays with subtrees in place of some of its leaves."""
    columns = [list(c) for c in top]
    for n, (feature, cut, left, right, value) in sorted(subtrees.items()):
        shift = len(columns[0]) - 1
        moved = [np.where(c > 0, c + shift, 0) for c in (left, right)]
        for column, root, rest in zip(columns, (feature[0], cut[0], moved[0][0], moved[1][0], value[0]), (feature[1:], cut[1:], moved[0][1:], moved[1][1:], value[1:])):
            column[n] = root
            column.extend(rest)
    return tuple(np.array(c, t) for c, t in zip(columns[:4], (np.uint16, np.uint16, np.int32, np.int32))) + (np.array(columns[4], np.float64),)


def fit_vector_forest(vectors: DataFrame, features: str, targets: Sequence[str], trees: int, depth: int, min_leaf: float,
                      max_bins: int = MAX_BINS, seed: int = 42, draw: bool = True, local_rows: int = LOCAL_ROWS) -> "VectorForest":
    """One forest for all targets; rows with an unknown target are left out. All features compete at each split."""
    known = vectors.where(" AND ".join(f"`{t}` IS NOT NULL" for t in targets))
    edges = bin_edges(known, features, max_bins)
    facts = known.agg(F.count("*").alias("n"), *[f(t).alias(f"{k}{i}") for i, t in enumerate(targets) for k, f in (("m", F.avg), ("v", F.var_pop))]).first()
    if not facts["n"]:
        raise ValueError("no rows with all targets known")
    centre = np.array([facts[f"m{i}"] for i in range(len(targets))])
    squares = facts["n"] * sum(facts[f"v{i}"] for i in range(len(targets)))
    shape = (len(edges), max((len(e) for e in edges), default=0) + 1, len(targets))
    blocks = blocks_of(known, features, targets, edges)
    try:
        table = grow_forest(blocks, shape, trees, depth, min_leaf, seed, centre, facts["n"], squares, draw, local_rows)
        kept = table.withColumn("n_bytes", F.octet_length("body").cast("bigint"))
    finally:
        blocks.unpersist()
    spec = {"features": features, "targets": list(targets), "edges": [e.tolist() for e in edges], "centre": centre.tolist(), "trees": trees}
    return VectorForest(spec, {"trees": kept})


class VectorForest(_TableModel):
    """Mean of the trees' leaves; columns ``<target>_prediction``.

    The trees are a table. They are broadcast in groups of a checked size, and a row passes
    once through each group.
    """

    spec = Param(Params._dummy(), "spec", "targets and edges", TypeConverters.identity)

    def __init__(self, spec: dict | None = None, tables: dict[str, DataFrame] | None = None) -> None:
        super().__init__((spec or {}).get("targets", ()), tables)
        self._set(spec=spec or {})

    def groups(self) -> list[list[int]]:
        """Trees that are sent together."""
        made, size = [], SENT_BYTES + 1
        for row in self.tables["trees"].select("tree", "n_bytes").orderBy("tree").collect():
            if size + row["n_bytes"] > SENT_BYTES:
                made.append([])
                size = 0
            made[-1].append(row["tree"])
            size += row["n_bytes"]
        return made

    def _transform(self, df: DataFrame) -> DataFrame:
        spec, names = self.getOrDefault(self.spec), df.columns
        edges = [np.array(e) for e in spec["edges"]]
        width = len(spec["targets"])
        rows = df.withColumn("_vector", vector_to_array(spec["features"])).withColumn("_sums", F.array(*[F.lit(0.0)] * width))
        for group in self.groups():
            bodies = self.tables["trees"].where(F.col("tree").isin(group)).select("body").collect()
            sent = df.sparkSession.sparkContext.broadcast([bytes(r["body"]) for r in bodies])
            rows = rows.withColumn("_sums", F.zip_with("_sums", leaf_sums(sent, edges, width)(F.col("_vector")), lambda a, b: a + b))
        answers = {f"{t}_prediction": F.col("_sums")[i] / spec["trees"] + F.lit(c) for i, (t, c) in enumerate(zip(spec["targets"], spec["centre"]))}
        return rows.select(*names, *[c.alias(n) for n, c in answers.items()])


def leaf_sums(sent, edges: Sequence[np.ndarray], width: int):
    """Column function: a vector's summed leaves over the broadcast trees."""

    @F.pandas_udf("array<double>")
    def sums(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trees = [pickle.loads(body) for body in sent.value]
        for vectors in batches:
            bins = into_bins(np.array(vectors.tolist(), np.float64).reshape(len(vectors), len(edges)), edges)
            total = np.zeros((len(vectors), width))
            for arrays in trees:
                total += arrays[4][landed(bins, arrays)]
            yield pd.Series(list(total))

    return sums
