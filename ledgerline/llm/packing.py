"""Best-fit-decreasing packing of token pieces, planned on their length histogram.

Pieces of one length are interchangeable, so a packing is a list of bins by content: each
``Group`` is a number of bins that hold the same lengths. There are at most as many lengths
as a sequence has tokens, and each length splits at most two groups and opens two, so the
plan's size depends on the sequence length alone, not on the number of documents. The plan
is made on the driver; tasks look up the place of each piece by its length and its number
among the pieces of that length.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, stored
from ledgerline.llm.tokens import id_type, pieces


@dataclass(frozen=True)
class Group:
    """``count`` bins that each hold the ``lengths``."""

    lengths: tuple[int, ...]
    count: int


class CapacityTree:
    """Segment tree over free capacities, to find the smallest one that fits."""

    def __init__(self, limit: int):
        self.size = 1 << limit.bit_length()
        self.any = [False] * (2 * self.size)
        self.groups: dict[int, list[Group]] = defaultdict(list)

    def add(self, free: int, group: Group) -> None:
        if group.count:
            self.groups[free].append(group)
            self._mark(free)

    def take(self, free: int) -> Group:
        group = self.groups[free].pop()
        self._mark(free)
        return group

    def _mark(self, free: int) -> None:
        node = self.size + free
        self.any[node] = bool(self.groups[free])
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] or self.any[2 * node + 1]

    def fitting(self, length: int) -> int | None:
        """The smallest free capacity of at least ``length`` that some bin has."""
        node = self.size + length
        if self.any[node]:
            return length
        while node > 1:  # up to the first ancestor with bins to the right, then down along the left
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit(histogram: dict[int, int], limit: int, groups: list[Group] = (), order: list[int] | None = None) -> list[Group]:
    """The groups after placing all lengths, longest first, each in the fullest bin it fits.

    Placing piece by piece gives the same: a bin that was the best fit and still has room
    for another piece of that length remains the best fit.
    """
    tree = CapacityTree(limit)
    for group in groups:
        tree.add(limit - sum(group.lengths), group)
    for length in order or sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            free = tree.fitting(length)
            group = Group((), left) if free is None else tree.take(free)
            free = limit if free is None else free
            fits = free // length
            full = min(group.count, left // fits)
            tree.add(free - fits * length, Group(group.lengths + (length,) * fits, full))
            left -= full * fits
            rest = group.count - full
            if rest and left:
                part = min(left, fits)
                tree.add(free - part * length, Group(group.lengths + (length,) * part, 1))
                left -= part
                rest -= 1
            if rest and group.lengths:
                tree.add(free, Group(group.lengths, rest))
    return [g for found in tree.groups.values() for g in found]


def bins_of(groups: list[Group]) -> int:
    return sum(g.count for g in groups)


class Slots:
    """Where the n-th piece of a length goes."""

    def __init__(self, groups: list[Group]):
        used: Counter[int] = Counter()
        rows, first_bin = [], 0
        for group in sorted(groups, key=lambda g: (-sum(g.lengths), g.lengths)):
            offset = 0
            for length, per_bin in sorted(Counter(group.lengths).items(), reverse=True):
                rows.append((length, used[length], first_bin, per_bin, offset))
                used[length] += group.count * per_bin
                offset += length * per_bin
            first_bin += group.count
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.keys = (table[:, 0] << 44) + table[:, 1]
        self.first, self.bins, self.per_bin, self.offsets = table[:, 1], table[:, 2], table[:, 3], table[:, 4]

    def places(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of each piece."""
        at = np.searchsorted(self.keys, (lengths << 44) + numbers, side="right") - 1
        inside = numbers - self.first[at]
        return self.bins[at] + inside // self.per_bin[at], self.offsets[at] + inside % self.per_bin[at] * lengths


def length_counts(cut: DataFrame) -> DataFrame:
    """(part, length, n) of stored pieces."""
    return stored(cut.groupBy("part", "length").agg(F.count("*").alias("n")), "length-counts")


def histogram(counts: DataFrame) -> dict[int, int]:
    """At most one number per possible length."""
    return {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}


def placed(cut: DataFrame, counts: DataFrame, groups: list[Group]) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``part`` and ``number`` are used up."""
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(
        counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")), "length-offsets"
    )
    numbered = join_few(cut, before, ["part", "length"], row_bytes=24, how="inner", salts=1).withColumn(
        "_n", F.col("number") + F.col("_before")
    ).drop("part", "number", "_before")
    shared = cut.sparkSession.sparkContext.broadcast(Slots(groups))
    kept = [f for f in numbered.schema.fields if f.name != "_n"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins, offsets = shared.value.places(batch["length"].to_numpy("int64"), batch["_n"].to_numpy("int64"))
            made = batch[[f.name for f in kept]].copy()
            made["doc_id"] = made["doc_id"].astype("Int64")
            yield made.assign(sequence_id=bins, offset=offsets)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return numbered.mapInPandas(place, schema + ", sequence_id bigint, offset bigint")


def packed_matrix(docs: DataFrame, limit: int = 2048, end: int = 50256, ranks: str | None = None) -> DataFrame:
    """One row per sequence: the ids as a row of a matrix, and what marks its documents.

    ``ids`` are ``limit`` little-endian numbers of 16 bits (of 32, if the vocabulary or the end
    id needs them; see ``tokens.id_type``), filled up with the end id after ``n_tokens``; ``cu_seqlens`` are the cumulative lengths of the segments from 0;
    ``reset_at`` the places where positions start again from 0; ``doc_ids``, ``pieces`` and
    ``starts`` say which part of which document a segment is.

    Defined results: null and empty texts are the end id alone. Longer documents than a
    sequence are cut without loss, all pieces full but the first. Documents without an id
    are packed with a null id; repeated rows are packed each. No documents give no
    sequences. Texts are read whole, other columns are not read.
    """
    kind = id_type(end, ranks)
    cut = stored(pieces(docs, limit, end, ranks, with_ids=True), "token-pieces")
    counts = length_counts(cut)
    rows = placed(cut.drop("ids_crc32"), counts, best_fit(histogram(counts), limit))
    ordered = rows.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_id, segments = None, []
        for batch in batches:
            made = []
            batch["doc_id"] = batch["doc_id"].astype("Int64")
            columns = [batch[c] for c in ("sequence_id", "doc_id", "piece", "start", "length", "ids")]
            for sequence, *segment in zip(*columns):
                if sequence != open_id and segments:
                    made.append(sequence_row(open_id, segments, limit, end, kind))
                    segments = []
                open_id = sequence
                segments.append(segment)
            if made:
                yield pd.DataFrame(made, columns=MATRIX)
        if segments:
            yield pd.DataFrame([sequence_row(open_id, segments, limit, end, kind)], columns=MATRIX)

    return ordered.mapInPandas(build, MATRIX_SCHEMA)


MATRIX = ["sequence_id", "n_tokens", "ids", "cu_seqlens", "reset_at", "doc_ids", "pieces", "starts"]
MATRIX_SCHEMA = (
    "sequence_id bigint, n_tokens int, ids binary, cu_seqlens array<int>, reset_at array<int>, "
    "doc_ids array<bigint>, pieces array<int>, starts array<bigint>"
)


def sequence_row(sequence: int, segments: list, limit: int, end: int, kind: str) -> tuple:
    docs, numbers, starts, lengths, ids = zip(*segments)
    ends = np.cumsum(lengths).tolist()
    filler = np.full(limit - ends[-1], end, kind).tobytes()
    ids_of = [None if pd.isna(d) else int(d) for d in docs]
    return sequence, ends[-1], b"".join(ids) + filler, [0, *ends], [0, *ends[:-1]], ids_of, list(numbers), list(starts)


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Writes the rows as Parquet; a lost task is written anew and only whole files are seen."""
    matrix.write.option("compression", "zstd").parquet(path)
