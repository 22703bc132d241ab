"""SimHash fingerprints, linked by pigeonring filtering.

A fingerprint has a bit for each of 64 places, set where over half of a text's shingle
hashes have it. Two fingerprints within t bits are linked. Cut into m segments in a ring,
they have a segment from which on every chain of l segments differs in at most l * t / m
bits. So the first segments of such a chain are equal: they are the key of a join, whose
condition checks the longer chains before the whole distance.

A key that many fingerprints share is not joined. Its fingerprints are linked exactly by
variants instead: two fingerprints are within two bits just if some value is within one bit
of both, so each is listed under itself and its 64 one-bit neighbours, and those listed
under one value are tied to the smallest. No group of rows is ever expanded into its pairs.

Defined results: null, empty and blank texts have no word and the fingerprint zero, linked
like any other. Documents without an id get a fingerprint; they are in a component of their
own kind (null) unless linked to one with an id. Equal fingerprints are one node. An empty
table gives an empty result. Texts are read whole, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, keyed, stored
from ledgerline.llm.components import components

SEED = 42
SEGMENTS = 8
MAX_BITS = 2
HOT_KEY = 64
BATCH_HASHES = 1 << 18


def text_fingerprint(text: str | None, ngram: int = 3) -> int:
    """The SimHash of one text as a signed 64-bit number."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    count = max(len(words) - ngram + 1, 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends - lengths + 1)[:count].tolist()
    stops = ends[min(ngram, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for first in range(0, count, BATCH_HASHES):
        last = min(first + BATCH_HASHES, count)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[first:last], stops[first:last])], np.uint64)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * set_bits > count, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, ngram: int = 3) -> DataFrame:
    """(doc_id, fp) per row of documents."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [text_fingerprint(t, ngram) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fp": pd.Series(values, dtype="int64")})

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInPandas(compute, "doc_id bigint, fp bigint")


def _rotated(fp: Column, places: Column | int) -> Column:
    places = F.lit(places) if isinstance(places, int) else places
    return F.call_function("shiftrightunsigned", fp, places).bitwiseOR(F.call_function("shiftleft", fp, (64 - places) % 64))


def equal_segments(max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> int:
    """Leading segments of a chain whose budget is under one bit."""
    return max(n for n in range(1, segments + 1) if n * max_bits < segments)


def ring_links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS, hot_key: int = HOT_KEY) -> DataFrame:
    """(a, b) of distinct fingerprints ``fp`` whose closure links all within ``max_bits`` bits."""
    if max_bits != 2:
        raise ValueError("hot keys are linked by one-bit variants, which fits two bits")
    width = 64 // segments
    lead = equal_segments(max_bits, segments)
    starts = F.explode(F.array(*[F.lit(i) for i in range(segments)]))
    keyed = fps.select("fp", starts.alias("start")).withColumn("ring", _rotated(F.col("fp"), F.col("start") * width)).withColumn(
        "key", F.col("ring").bitwiseAND(F.lit((1 << (lead * width)) - 1))
    )
    keyed = stored(keyed, "ring-keys")
    counts = keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    sized = keyed.join(counts, ["start", "key"])
    small = sized.where(F.col("n") <= hot_key).drop("n")
    left, right = small.alias("l"), small.alias("r")
    apart = F.col("l.ring").bitwiseXOR(F.col("r.ring"))
    viable = F.col("l.fp") > F.col("r.fp")
    for chain in range(lead + 1, segments + 1):
        low_bits = apart if chain == segments else apart.bitwiseAND(F.lit((1 << (chain * width)) - 1))
        viable = viable & (F.bit_count(low_bits) <= chain * max_bits // segments)
    same = (F.col("l.start") == F.col("r.start")) & (F.col("l.key") == F.col("r.key"))
    pairs = left.join(right, same & viable).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    hot = sized.where(F.col("n") > hot_key).select("fp").distinct()
    flips = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(64)])
    listed = hot.select("fp", F.explode(F.transform(flips, lambda m: m.bitwiseXOR(F.col("fp")))).alias("near"))
    least = listed.groupBy("near").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    ties = listed.join(least, "near").where("fp <> b").select(F.col("fp").alias("a"), "b")
    return pairs.union(ties).distinct()


def simhash_components(docs: DataFrame, ngram: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) per row; component_id is the smallest id reachable."""
    rows = stored(fingerprints(docs, ngram), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    reach = components(ring_links(nodes.select("fp"), max_bits)).select(F.col("node").alias("fp"), "component")
    labelled = nodes.join(reach, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    firsts = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = labelled.join(firsts, "component").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows, in the same columns, whose document comes first in its component.

    Rows that share id and text are one document, of which one row stays. Only the keys of
    dropped documents are joined back; they are broadcast while they are few.
    """
    rows, unique = keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_original")))
    base = rows if unique else rows.dropDuplicates(["_key"])
    found = simhash_components(base.select(F.col("_key").alias("doc_id"), "text"))
    dropped = stored(
        found.where("doc_id <> component_id").select(F.col("doc_id").alias("_key"), F.lit(True).alias("_gone")), "dropped")
    return join_few(base, dropped, ["_key"], salts=1).where("_gone IS NULL").select("_original.*")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint as 16 hexadecimal digits, component_id."""
    found = simhash_components(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
