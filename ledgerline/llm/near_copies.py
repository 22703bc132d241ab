"""Groups of near-copies: an exact set-similarity join of whole documents, then components.

A document's tokens are the 64-bit hashes of its distinct five-word shingles (all its words,
if fewer), of words without regard to ASCII case. Two documents are linked if their token
sets have a Jaccard similarity of p/q = 4/5 or more. Every such pair counts: no fingerprint
decides, as 64 bits of two sets with this similarity are some ten bits apart and up to
fourteen have to be allowed, for which a ring of segments has keys of four bits.

1. Documents with the same token set (by two 64-bit hashes) are one node, the first of them.
2. Tokens are ordered by rarity as in ``line_dedup``; documents that are similar enough share
   one of the first n - ceil(4n/5) + 1 tokens in this order, which are indexed.
3. In each group of a shared token, a document is compared with the first one of the group
   and the one before it; bounds from sizes and places go first, what passes is verified.
4. Groups of over three whose members are not all in one component of these links are
   joined, but only across components, so a family of many variants is not expanded.

Defined results: null, empty and blank texts are one group. Of rows that share id and text
one stays. An empty table gives an empty result. Other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, keyed, stored
from ledgerline.llm.components import components
from ledgerline.llm.line_dedup import CLASSES, LOW_BITS, P, Q, SHINGLE_WORDS, _may_match

SEED = 42


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The distinct hashes of a text's shingles, ascending; a text without words has the hash 0."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(1, np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(w, SEED) for w in found), np.uint64, len(found))
    width = min(words, len(found))
    count = len(found) - width + 1
    mixed = np.full(count, width, np.uint64)
    for i in range(width):
        mixed ^= hashes[i:i + count]
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _sets_and_classes(base: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(_key, a, b) with two hashes of each token set, and the rank by rarity of each hash class."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        totals = np.zeros(CLASSES, np.int64)
        for batch in batches:
            names = []
            for text in batch["text"]:
                tokens = shingles(text)
                totals += np.bincount((tokens % np.uint64(CLASSES)).astype(np.int64), minlength=CLASSES)
                names.append([xxhash.xxh64_intdigest(tokens.tobytes(), s) for s in (0, 1)])
            pair = np.array(names, np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"_key": batch["_key"], "a": pair[:, 0], "b": pair[:, 1], "counts": None})
        yield pd.DataFrame({"_key": [0], "a": [0], "b": [0], "counts": [totals]})

    rows = stored(base.select("_key", "text").mapInPandas(compute, "_key bigint, a bigint, b bigint, counts array<bigint>"), "token-sets")
    counted = rows.where("counts IS NOT NULL").select(F.posexplode("counts").alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n")).collect()
    ranks = np.zeros(CLASSES, np.int64)
    for place, row in enumerate(sorted(counted, key=lambda r: (r["n"], r["c"]))):
        ranks[row["c"]] = place
    return rows.where("counts IS NULL").select("_key", "a", "b"), ranks


def _prefix_rows(base: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(token, _key, n, place) of the indexed tokens; place counts from 1."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, prefixes = [], []
            for text in batch["text"]:
                tokens = shingles(text)
                n = len(tokens)
                kept = n - -(-P * n // Q) + 1
                order = ranks[(tokens % np.uint64(CLASSES)).astype(np.int64)] << 50 | (tokens & np.uint64(LOW_BITS)).astype(np.int64)
                sizes.append(n)
                prefixes.append(np.sort(order)[:kept])
            yield pd.DataFrame({"_key": batch["_key"], "n": pd.Series(sizes, dtype="int32"), "prefix": prefixes})

    found = base.select("_key", "text").mapInPandas(compute, "_key bigint, n int, prefix array<bigint>")
    return found.select("_key", "n", F.posexplode("prefix").alias("place", "token")).withColumn("place", F.col("place") + 1)


def _verified(pairs: DataFrame, base: DataFrame) -> DataFrame:
    """The stored pairs (x_key, y_key) whose token sets are similar enough, as edges (a, b)."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"_key": batch["_key"], "t": [shingles(t).view(np.int64) for t in batch["text"]]})

    ends = pairs.select(F.col("x_key").alias("_key")).union(pairs.select("y_key")).distinct()
    ends = stored(ends.withColumn("_end", F.lit(True)), "pair-ends")
    wanted = join_few(base.select("_key", "text"), ends, ["_key"], row_bytes=24, how="inner", salts=1)
    sets = stored(wanted.select("_key", "text").mapInPandas(compute, "_key bigint, t array<bigint>"), "pair-sets")
    x = sets.select(F.col("_key").alias("x_key"), F.col("t").alias("xt"))
    y = sets.select(F.col("_key").alias("y_key"), F.col("t").alias("yt"))
    both = pairs.join(x, "x_key").join(y, "y_key").withColumn("_c", F.expr("size(array_intersect(xt, yt))"))
    return both.where(F.expr(f"{Q} * _c >= {P} * (size(xt) + size(yt) - _c)")).select(F.col("y_key").alias("a"), F.col("x_key").alias("b"))


def links(base: DataFrame, ranks: np.ndarray) -> DataFrame:
    """(a, b) whose closure links all pairs of similar rows (_key, text) of distinct token sets."""
    groups = Window.partitionBy("token")
    in_order = groups.orderBy("_key")
    me = F.struct("_key", "n", "place")
    shared = stored(
        _prefix_rows(base, ranks).withColumn("_first", F.first(me).over(in_order)).withColumn("_last", F.lag(me).over(in_order))
        .withColumn("_m", F.count("*").over(groups)).where("_m > 1"),
        "shared-tokens",
    )
    near = shared.select(
        F.col("_key").alias("y_key"), F.col("n").alias("yn"), F.col("place").alias("yplace"),
        F.explode(F.array("_first", "_last")).alias("x"),
    ).select("y_key", "yn", "yplace", F.col("x._key").alias("x_key"), F.col("x.n").alias("xn"), F.col("x.place").alias("xplace"))
    pairs = stored(near.where((F.col("x_key") < F.col("y_key")) & _may_match("x", "y")).select("x_key", "y_key").distinct(), "near-pairs")
    found = stored(_verified(pairs, base), "near-links")

    reach = stored(components(found).select(F.col("node").alias("_key"), "component"), "reach")
    large = join_few(shared.where("_m > 3").select("token", "_key", "n", "place"), reach, ["_key"], row_bytes=24, salts=1)
    large = large.withColumn("component", F.coalesce("component", "_key"))
    mixed = large.groupBy("token").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low < _high")
    open_rows = stored(large.join(mixed.select("token"), "token", "left_semi"), "open-tokens")
    side = lambda s: open_rows.select("token", *[F.col(c).alias(f"{s}{n}") for c, n in (("_key", "_key"), ("n", "n"), ("place", "place"), ("component", "component"))])
    across = F.expr("x_key < y_key AND xcomponent <> ycomponent") & _may_match("x", "y")
    rest = side("y").join(side("x"), "token").where(across).select("x_key", "y_key").distinct()
    late = stored(rest.join(pairs, ["x_key", "y_key"], "left_anti"), "late-pairs")
    return found.union(_verified(late, base))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows, in the same columns, whose document comes first in its group.

    Only the keys of dropped documents are joined back; they are broadcast while they are few.
    """
    rows, unique = keyed(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_original")))
    base = rows if unique else rows.dropDuplicates(["_key"])
    sets, ranks = _sets_and_classes(base)
    firsts = sets.groupBy("a", "b").agg(F.min("_key").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    copies = stored(
        sets.join(firsts, ["a", "b"]).where("_key <> _first").select("_key", F.lit(True).alias("_gone")), "copies")
    nodes = join_few(base.select("_key", "text"), copies, ["_key"], row_bytes=24, salts=1).where("_gone IS NULL").drop("_gone")
    reach = components(links(nodes, ranks)).where("node <> component")
    dropped = stored(copies.union(reach.select(F.col("node").alias("_key"), F.lit(True).alias("_gone"))), "dropped")
    return join_few(base, dropped, ["_key"], row_bytes=24, salts=1).where("_gone IS NULL").select("_original.*")
