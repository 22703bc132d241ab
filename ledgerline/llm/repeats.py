"""Removal of repeated byte strings, with a logarithmic family of suffix arrays.

A byte goes if a string of ``LEAST`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in its own. Strings are judged on the input.

1. Every such string has an anchor, the place of its smallest ``GRAM``-byte hash. Strings
   next to each other mostly share theirs, so a document is a list of stretches: the strings
   of one anchor, some 30 of them. Equal strings have equal grams at their anchors.
2. Stretches meet by the hash of their gram. A later stretch with the same bytes is a repeat
   as a whole. If a gram has stretches of different bytes, the first of each is fetched.
3. Fetched stretches are indexed batch by batch in the order of documents. A batch gets the
   sorted array of its suffixes, cut at ``LEAST`` bytes; it is scanned against the levels of
   the index, joins them as a new level, and levels of equal size are merged.
4. A gram with very many different stretches is split over tasks, each with an index of its
   own; their first strings then meet by a hash of the strings in a second family of indexes.

Suffixes start at the strings of fetched stretches only, and the index is split by grams: one
suffix array of the whole corpus would have to be merged in a single task. Tasks hold a
bounded number of stretches at a time, and levels last as long as the task that holds them.
Whole stretches are compared by two 64-bit hashes, of gram and content, fetched ones by bytes.

Defined results: null and empty texts have no bytes; shorter ones than ``LEAST`` lose none.
Rows that share an id are ordered by their texts' hashes; rows that also share the text are
one document and get its result each. Rows without an id come after all others. An empty
table gives an empty result. Texts are read whole, other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, stored

LEAST = 100
GRAM = 32
BLOCK = 1 << 21  # bytes that are hashed at a time
GROUP = 4096  # stretches of a gram that share an index
CHUNK = 8192  # stretches that a task indexes at a time
BATCH = 1 << 16  # suffixes of a batch of the index

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    found = np.full(count, base, np.uint64)
    found[0] = 1
    return np.cumprod(found, dtype=np.uint64)


_BYTE = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row, from running minima of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def stretches(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, content hash, first start, last start) of the stretches of documents that
    lie one after another in ``data`` and end at ``ends``."""
    n = len(data)
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < LEAST:
        return none
    powers, inverse = _powers(_ODD, n), _powers(_INVERSE, n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * inverse, out=sums[1:])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * powers[:n - GRAM + 1])
    low = np.uint64((1 << 24) - 1)
    places = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least((grams & ~low) | places, LEAST - GRAM + 1) & low
    inside = np.ones(len(least), bool)
    for back in range(1, LEAST):  # strings that would cross the end of a document
        at = ends - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none
    anchors = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = starts[new]
    last = starts[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]
    content = _mixed((sums[last + LEAST] - sums[first]) * powers[first] + (last - first).astype(np.uint64))
    return grams[anchors[new]], content, first, last


def _blocks(data: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents packed into blocks: (bytes, ends, document number, its first byte in the block)
    where a long document is cut into parts that overlap by a string less one byte."""
    parts, size = [], 0

    def flush():
        whole = np.frombuffer(b"".join(p for p, _, _ in parts), np.uint8)
        return whole, np.cumsum([len(p) for p, _, _ in parts]), np.array([d for _, d, _ in parts]), np.array([o for _, _, o in parts])

    for number, text in enumerate(data):
        for offset in range(0, max(len(text) - LEAST + 1, 0), BLOCK):
            part = text[offset:offset + BLOCK + LEAST - 1]
            if parts and size + len(part) > BLOCK:
                yield flush()
                parts, size = [], 0
            parts.append((part, number, offset))
            size += len(part)
    if parts:
        yield flush()


def _runs(docs: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals in order of (document, start), with those that touch joined."""
    if not len(docs):
        return docs, starts, stops
    order = np.lexsort((starts, docs))
    docs, starts, stops = docs[order], starts[order], stops[order]
    # Documents are shifted apart, so one running maximum serves all of them.
    number = np.cumsum(np.append(0, docs[1:] != docs[:-1]))
    shift = number * (int(stops.max()) + 1)
    reach = np.maximum.accumulate(stops + shift)
    new = np.append(True, (starts + shift)[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return docs[at], starts[at], (reach - shift)[np.append(at[1:] - 1, len(docs) - 1)]


MARKS = "gram bigint, content bigint, doc_id bigint, start bigint, length bigint, covered boolean"


def _marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stretches of each batch; those that repeat inside the batch are covered already."""
    for batch in batches:
        batch = batch.sort_values("doc_id", kind="stable")
        ids = batch["doc_id"].to_numpy("int64")
        found = [[], [], [], [], []]
        for whole, ends, numbers, offsets in _blocks(batch["data"].tolist()):
            gram, content, first, last = stretches(whole, ends)
            part = np.searchsorted(ends, first, side="right")
            begins = np.append(0, ends[:-1])[part]
            rows = gram, content, ids[numbers[part]], first - begins + offsets[part], last - first + LEAST
            for column, values in zip(found, rows):
                column.append(values)
        if not found[0]:
            continue
        gram, content, docs, starts, lengths = map(np.concatenate, found)
        order = np.argsort(gram ^ (content * np.uint64(_ODD)), kind="stable")
        same = np.append(False, (gram[order][1:] == gram[order][:-1]) & (content[order][1:] == content[order][:-1]))
        again, firsts = order[same], order[~same]
        d, a, b = _runs(docs[again], starts[again], (starts + lengths)[again])
        yield pd.DataFrame({
            "gram": np.append(gram[firsts].view(np.int64), d), "content": np.append(content[firsts].view(np.int64), np.zeros(len(d), np.int64)),
            "doc_id": np.append(docs[firsts], d), "start": np.append(starts[firsts], a),
            "length": np.append(lengths[firsts], b - a), "covered": np.append(np.zeros(len(firsts), bool), np.ones(len(d), bool)),
        })


CLASSES = "gram bigint, split int, doc_id bigint, start bigint, length bigint, covered boolean"


def _classes(group: int):
    """Rows in order of gram, content, document, start: repeated stretches are covered; the
    first of each content is kept if its gram has another one."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["gram", "doc_id", "start", "length"]
        pending, place = None, 0  # the last first stretch, and its place among those of its gram
        last = None
        sent = False  # whether pending has gone out
        for batch in batches:
            done = batch[batch["covered"]]
            if len(done):
                yield done[["gram", "doc_id", "start", "length", "covered"]].assign(split=0)[[c.split()[0] for c in CLASSES.split(", ")]]
            rows = batch[~batch["covered"]]
            if not len(rows):
                continue
            gram, content = rows["gram"].to_numpy(), rows["content"].to_numpy()
            before_gram = np.append(last[0] if last else ~gram[0], gram[:-1])
            before_content = np.append(last[1] if last else 0, content[:-1])
            new_gram = gram != before_gram
            new = new_gram | (content != before_content)
            last = gram[-1], content[-1]
            out = []
            if (~new).any():
                out.append(rows.loc[~new, columns].assign(covered=True, split=0))
            firsts = rows.loc[new, columns]
            if len(firsts):
                starts_gram = new_gram[new]
                if pending is not None:
                    firsts = pd.concat([pending, firsts])
                    starts_gram = np.append(place == 0, starts_gram)
                number = np.arange(len(firsts))
                opened = np.maximum.accumulate(np.where(starts_gram, number, -1))
                places = np.where(opened >= 0, number - opened, number + place)
                # The last one waits: the next batch may bring another content of its gram.
                followed = np.append(~starts_gram[1:], False)
                wanted = ~starts_gram | followed
                skip = np.zeros(len(firsts), bool)
                skip[0] = sent and pending is not None
                go = wanted & ~skip
                out.append(firsts[go].assign(covered=False, split=(places[go] // group).astype("int32")))
                sent = bool(go[-1]) or (len(firsts) == 1 and sent)
                pending, place = firsts.iloc[-1:], int(places[-1])
            if out:
                yield pd.concat(out)[[c.split()[0] for c in CLASSES.split(", ")]]

    return run


class LevelFamily:
    """Sorted arrays of suffixes whose sizes grow geometrically."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def scan(self, suffixes: np.ndarray) -> np.ndarray:
        """Which of the sorted suffixes some level has."""
        known = np.zeros(len(suffixes), bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, suffixes), len(level) - 1)
            known |= level[at] == suffixes
        return known

    def add(self, suffixes: np.ndarray) -> None:
        """A new level of sorted suffixes that no other level has; levels no larger are merged into it."""
        while self.levels and len(self.levels[-1]) <= len(suffixes):
            suffixes = np.sort(np.concatenate([self.levels.pop(), suffixes]), kind="stable")
        if len(suffixes):
            self.levels.append(suffixes)

    def first_seen(self, suffixes: np.ndarray) -> np.ndarray:
        """Which suffixes of a batch, given in order, are the first of their kind so far."""
        order = np.argsort(suffixes, kind="stable")
        array = suffixes[order]
        distinct = np.append(True, array[1:] != array[:-1])
        fresh = np.zeros(len(order), bool)
        fresh[distinct] = ~self.scan(array[distinct])
        self.add(array[fresh])
        first = np.zeros(len(order), bool)
        first[order[fresh]] = True
        return first


def _suffixes(contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of the contexts in order, with the number of their context and their start in it."""
    lengths = np.array([len(c) for c in contexts])
    counts = lengths - LEAST + 1
    number = np.repeat(np.arange(len(contexts)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    whole = np.frombuffer(b"".join(contexts), np.uint8)
    at = (np.cumsum(lengths) - lengths)[number] + inside
    rows = np.lib.stride_tricks.sliding_window_view(whole, LEAST)[at]
    return np.ascontiguousarray(rows).view(f"S{LEAST}").ravel(), number, inside


FOUND = "doc_id bigint, start bigint, length bigint, covered boolean, string binary"


def _indexed(rows: pd.DataFrame, contexts: str, want_firsts: bool) -> Iterator[pd.DataFrame]:
    """Covered intervals of the rows, and the first strings of those that are split."""
    rows = rows.sort_values(["doc_id", "start"], kind="stable")
    docs, starts = rows["doc_id"].to_numpy("int64"), rows["start"].to_numpy("int64")
    hot = rows["hot"].to_numpy(bool) if want_firsts else np.zeros(len(rows), bool)
    texts = rows[contexts].tolist()
    sizes = np.cumsum([len(t) - LEAST + 1 for t in texts])
    family, begin = LevelFamily(), 0
    while begin < len(texts):
        stop = max(int(np.searchsorted(sizes, (sizes[begin - 1] if begin else 0) + BATCH, side="right")), begin + 1)
        suffixes, number, inside = _suffixes(texts[begin:stop])
        number = number + begin
        first = family.first_seen(suffixes)
        again = ~first
        at = starts[number] + inside
        d, a, b = _runs(docs[number[again]], at[again], at[again] + LEAST)
        yield pd.DataFrame({"doc_id": d, "start": a, "length": b - a, "covered": True, "string": None})
        keep = np.flatnonzero(first & hot[number]) if want_firsts else []
        for some in range(0, len(keep), BATCH):
            own = keep[some:some + BATCH]
            yield pd.DataFrame({"doc_id": docs[number[own]], "start": at[own], "length": LEAST, "covered": False,
                                "string": [suffixes[i].ljust(LEAST, b"\0") for i in own]})
        begin = stop


def _families(keys: list[str], contexts: str, want_firsts: bool, chunk: int):
    """Indexes whole groups of rows, which arrive in order, some ``chunk`` rows at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size < 2 * chunk:
                continue
            rows = pd.concat(waiting)
            while len(rows) >= 2 * chunk:
                values = rows[keys].to_numpy()
                changes = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
                place = np.searchsorted(changes, chunk)
                if place == len(changes):
                    break
                yield from _indexed(rows.iloc[:changes[place]], contexts, want_firsts)
                rows = rows.iloc[changes[place]:]
            waiting, size = [rows], len(rows)
        if size:
            yield from _indexed(pd.concat(waiting), contexts, want_firsts)

    return run


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, data) with unique ids, and what ties rows to them if the ids were not.

    Ids that are missing or shared are replaced by the rank of (id, hash of the text).
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    shared = plain.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        return plain, None
    tied = plain.withColumn("_tie", F.xxhash64("data")).withColumn("_none", F.col("doc_id").isNull()).withColumn(
        "_id", F.coalesce("doc_id", F.lit(0)))
    order = ["_none", "_id", "_tie"]
    pinned = stored(tied.select(*order).distinct().repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per task
    ranks = pinned.join(F.broadcast(before), "_part").withColumn(
        "_rank", F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ).select(*order, "_rank")
    ranked = stored(tied.join(ranks, order), "ranked-documents")
    once = ranked.dropDuplicates(["_rank"]).select(F.col("_rank").alias("doc_id"), "data")
    return once, ranked.select("doc_id", "_rank")


def repeated_intervals(base: DataFrame, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, start, length) of bytes that go, for (doc_id, data) with unique ids."""
    marks = base.mapInPandas(_marks, MARKS)
    in_order = marks.repartition("gram").sortWithinPartitions("gram", "content", "doc_id", "start")
    found = stored(in_order.mapInPandas(_classes(group), CLASSES), "stretches")
    wanted = found.where("NOT covered").drop("covered")
    split = stored(wanted.where("split > 0").select("gram").distinct().withColumn("hot", F.lit(True)), "split-grams")
    any_split = not split.isEmpty()
    wanted = join_few(wanted, split, ["gram"]).withColumn("hot", F.coalesce("hot", F.lit(False)))
    fetched = base.join(wanted, "doc_id").select(
        "gram", "split", "hot", "doc_id", "start", F.expr("substring(data, CAST(start + 1 AS int), CAST(length AS int))").alias("bytes")
    )
    grouped = fetched.repartition("gram", "split").sortWithinPartitions("gram", "split", "doc_id", "start")
    covered = grouped.mapInPandas(_families(["gram", "split"], "bytes", any_split, chunk), FOUND)
    parts = [found.where("covered").select("doc_id", "start", "length")]
    if any_split:
        covered = stored(covered, "indexed")
        firsts = covered.where("NOT covered").select(F.xxhash64("string").alias("place"), "doc_id", "start", "string")
        met = firsts.repartition("place").sortWithinPartitions("place", "doc_id", "start")
        again = met.mapInPandas(_families(["place"], "string", False, 50 * chunk), FOUND)
        parts.append(again.where("covered").select("doc_id", "start", "length"))
        covered = covered.where("covered")
    parts.append(covered.select("doc_id", "start", "length"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def _kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, data, gone in zip(batch["doc_id"], batch["data"], batch["gone"]):
            digest, removed, spans, at = hashlib.sha256(), 0, 0, 0
            kept = []
            if gone is not None and len(gone):
                _, starts, stops = _runs(np.zeros(len(gone), np.int64), np.array([g["a"] for g in gone]), np.array([g["b"] for g in gone]))
                for a, b in zip(starts.tolist(), stops.tolist()):
                    kept.append(data[at:a])
                    removed, spans, at = removed + b - a, spans + 1, b
            kept.append(data[at:])
            joined = b"".join(kept)
            digest.update(joined)
            rows.append((doc, len(data), removed, spans, digest.hexdigest(), joined))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, with_bytes: bool = True, group: int = GROUP, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining bytes ``kept``."""
    base, ties = _keyed(docs)
    gone = repeated_intervals(base, group, chunk).groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("start").alias("a"), (F.col("start") + F.col("length")).alias("b"))).alias("gone")
    )
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"

    def run(batches):
        for made in _kept(batches):
            yield made if with_bytes else made.drop(columns="kept")

    result = base.join(gone, "doc_id", "left").mapInPandas(run, schema if with_bytes else schema.rpartition(",")[0])
    if ties is None:
        return result
    return ties.join(result.withColumnRenamed("doc_id", "_rank"), "_rank").drop("_rank")


def report(docs: DataFrame) -> DataFrame:
    return without_repeats(docs, with_bytes=False)
