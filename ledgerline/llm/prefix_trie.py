"""The trie of conversation prefixes, from fingerprints that compose without rebuilding texts.

A turn is a number modulo the prime 2^61 - 1, a sequence of turns the pair (sum of its turns
times powers of a base, length). Such pairs are a monoid: joining two sequences multiplies the
second sum by the base to the length of the first and adds. A prefix of a rebuilt conversation
is a head of one stored conversation joined to a stretch of another, so its fingerprint comes
from three stored prefix sums, and no rebuilt text is ever made. Two primes' worth of lanes
with different bases stand side by side.

Fingerprints propose the nodes; equality is verified. Equal turn numbers must be equal roles
and texts in the stored turns, and all members of a node must have the same parent node and
refer to stored turns of the same number; by induction on the depth they then agree in all
their turns. If either fails, everything is done again with other bases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.ordered import all_of, running_sums

PRIME = (1 << 61) - 1
LANES = (0, 1)
ATTEMPTS = 8
NODE = ["depth", *[f"f{i}" for i in LANES]]
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, in 64-bit halves."""
    a, b = a.astype(np.uint64), b.astype(np.uint64)
    half, low = np.uint64(32), np.uint64(0xFFFFFFFF)
    ah, al, bh, bl = a >> half, a & low, b >> half, b & low
    middle = ah * bl + al * bh
    lowest = al * bl
    total = (
        (ah * bh << np.uint64(3)) + (middle >> np.uint64(29)) + ((middle & np.uint64((1 << 29) - 1)) << half)
        + (lowest >> np.uint64(61)) + (lowest & np.uint64(PRIME))
    )
    return total % np.uint64(PRIME)


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """The base to each exponent, modulo the prime."""
    distinct, places = np.unique(exponents, return_inverse=True)
    return np.array([pow(base, int(e), PRIME) for e in distinct], np.uint64)[places]


def base_of(lane: int, attempt: int) -> int:
    """A base for a lane; each attempt has its own."""
    digest = hashlib.sha256(f"{lane}:{attempt}".encode()).digest()
    return int.from_bytes(digest[:8], "big") % (PRIME - 3) + 2


def scaled(base: int):
    """Column function: number times the base to a power that may be negative."""

    @F.pandas_udf("bigint")
    def times(value: pd.Series, exponent: pd.Series) -> pd.Series:
        return pd.Series(multiply(value.to_numpy(), power(base, exponent.to_numpy())).astype(np.int64))

    return times


def modulo(value: Column) -> Column:
    return F.pmod(value, F.lit(PRIME).cast("decimal(19,0)")).cast("bigint")


def wide(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(19,0)")


def plain_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text; null roles and texts are empty, rows without conv_id are left out."""
    empty = F.lit("")
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("text"),
    ).where("conv_id IS NOT NULL")


def numbered(turns: DataFrame, attempt: int) -> DataFrame:
    """Each turn with its two numbers; turns that share their place in the order also carry their texts."""
    numbers = {
        f"h{i}": F.pmod(F.xxhash64(F.lit(2 * attempt + i), "role", "text"), F.lit(PRIME)) for i in LANES
    }
    shared = turns.groupBy("conv_id", "turn").agg(F.count("*").alias("n")).where("n > 1")
    if shared.isEmpty():
        tie = {"tie_role": F.lit(None).cast("string"), "tie_text": F.lit(None).cast("string")}
    else:
        marked = shared.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.lit(True).alias("tied"))
        turns = turns.join(marked, (F.col("conv_id") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")), "left")
        tie = {"tie_role": F.when(F.col("tied"), F.col("role")), "tie_text": F.when(F.col("tied"), F.col("text"))}
    return turns.withColumns({**numbers, **tie}).select(
        "conv_id", "turn", "tie_role", "tie_text", *numbers, F.length("text").cast("bigint").alias("n_chars")
    )


def turns_agree(turns: DataFrame, attempt: int) -> bool:
    """Whether equal turn numbers are equal roles and texts, over all stored turns."""
    numbers = [F.pmod(F.xxhash64(F.lit(2 * attempt + i), "role", "text"), F.lit(PRIME)).alias(f"h{i}") for i in LANES]
    distinct = turns.select(*numbers, "role", "text").distinct()
    return distinct.groupBy("h0", "h1").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def prefix_sums(turns: DataFrame, attempt: int) -> DataFrame:
    """Stored turns by (conv_id, idx from 1): turn numbers, prefix sums ``v`` with and ``u`` without the turn."""
    rows = numbered(turns, attempt)
    order = ["turn", "tie_role", "tie_text"]
    places = running_sums(rows, ["conv_id"], order, {"idx": F.lit(1).cast("bigint")}, "turn-places")
    terms = places.select("conv_id", "idx", "h0", "h1", "n_chars", *[
        scaled(base_of(i, attempt))(F.col(f"h{i}"), F.col("idx")).alias(f"t{i}") for i in LANES
    ])
    summed = running_sums(terms, ["conv_id"], ["idx"], {f"s{i}": wide(f"t{i}") for i in LANES}, "turn-terms")
    return stored(summed.select(
        "conv_id", "idx", "n_chars", *[f"h{i}" for i in LANES],
        *[modulo(F.col(f"s{i}")).alias(f"v{i}") for i in LANES],
        *[modulo(F.col(f"s{i}") - wide(f"t{i}")).alias(f"u{i}") for i in LANES],
    ), "turn-sums")


def planned(recipes: DataFrame, turns: DataFrame) -> DataFrame:
    """Each recipe with the length ``taken`` of its head and the stored sums its fingerprints need."""
    counts = turns.groupBy("conv_id").agg(F.max("idx").alias("n"))
    heads = counts.select(F.col("conv_id").alias("base_id"), F.col("n").alias("n_base"))
    sized = recipes.join(counts, "conv_id", "left").join(heads, "base_id", "left").select(
        "conv_id", "base_id", "head", F.coalesce("n", F.lit(0)).alias("own"),
        F.least("head", F.coalesce("n_base", F.lit(0))).alias("taken"),
    )
    at_base = turns.select(F.col("conv_id").alias("base_id"), F.col("idx").alias("taken"), *[F.col(f"v{i}").alias(f"b{i}") for i in LANES])
    at_own = turns.select("conv_id", F.col("idx").alias("head"), *[F.col(f"v{i}").alias(f"o{i}") for i in LANES])
    sums = sized.join(at_base, ["base_id", "taken"], "left").join(at_own, ["conv_id", "head"], "left")
    zero = {f"{k}{i}": F.coalesce(f"{k}{i}", F.lit(0)) for k in "bo" for i in LANES}
    length = F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return stored(sums.withColumns({**zero, "length": length}), "recipes")


def prefixes(plan: DataFrame, turns: DataFrame, attempt: int) -> DataFrame:
    """One row per prefix of every rebuilt conversation: its node, its parent, its last stored turn.

    ``f`` and ``p`` are the fingerprints with and without the last turn, ``ref_conv`` and
    ``ref_idx`` say which stored turn that is.
    """
    kept = ["n_chars", *[f"h{i}" for i in LANES]]
    stored_turns = turns.withColumnRenamed("conv_id", "ref_conv").withColumnRenamed("idx", "ref_idx")
    head = plan.select("conv_id", "base_id", "taken", "length").where("taken > 0").join(
        stored_turns, (F.col("base_id") == F.col("ref_conv")) & (F.col("ref_idx") <= F.col("taken"))
    ).select(
        "conv_id", "length", F.col("ref_idx").alias("depth"), "ref_conv", "ref_idx", *kept,
        *[F.col(f"v{i}").alias(f"f{i}") for i in LANES], *[F.col(f"u{i}").alias(f"p{i}") for i in LANES],
    )
    own = plan.where("own > head").join(
        turns.withColumnRenamed("idx", "ref_idx"), "conv_id"
    ).where("ref_idx > head")

    def composed(value: str, i: int) -> Column:
        stretch = modulo(wide(value) - wide(f"o{i}"))
        moved = scaled(base_of(i, attempt))(stretch, F.col("taken") - F.col("head"))
        return modulo(wide(f"b{i}") + wide(moved))

    suffix = own.select(
        "conv_id", "length", (F.col("ref_idx") - F.col("head") + F.col("taken")).alias("depth"),
        F.col("conv_id").alias("ref_conv"), "ref_idx", *kept,
        *[composed(f"v{i}", i).alias(f"f{i}") for i in LANES], *[composed(f"u{i}", i).alias(f"p{i}") for i in LANES],
    )
    none = F.lit(0).cast("bigint")
    missing = F.lit(None).cast("bigint")
    root = plan.select(
        "conv_id", "length", none.alias("depth"), missing.alias("ref_conv"), missing.alias("ref_idx"),
        *[none.alias(k) for k in kept], *[none.alias(f"{k}{i}") for k in "fp" for i in LANES],
    )
    return stored(head.unionByName(suffix).unionByName(root), "prefixes")


def grouped(rows: DataFrame) -> DataFrame:
    """One row per node with its smallest member, its counts, and whether its members agree."""
    same = [c for i in LANES for c in (f"p{i}", f"h{i}")]
    nodes = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.sum((F.col("depth") == F.col("length")).cast("bigint")).alias("ends"),
        F.min("n_chars").alias("n_chars"),
        F.min_by("ref_conv", "conv_id").alias("turn_conv_id"), F.min_by("ref_idx", "conv_id").alias("turn_index"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"_{c}") for c in same],
    )
    agree = all_of([F.col(c) == F.col(f"_{c}") for c in same])
    return stored(nodes.withColumn("agree", agree).drop(*[f"_{c}" for c in same]), "nodes")


def end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the sorted ids of the conversations that end at each node.

    Ids are sorted over range partitions, so those of one node spread over many tasks, and are
    joined to pieces there; the digest of a node then reads its pieces in order, one at a time.
    """
    ends = rows.where("depth = length").select(*NODE, "conv_id")
    ordered = ends.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")

    def join_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = batch.groupby(NODE, sort=False)["conv_id"].agg(
                first="min", ids=lambda ids: ",".join(map(str, ids.tolist()))
            )
            yield made.reset_index()

    pieces = ordered.mapInPandas(join_ids, "depth bigint, f0 bigint, f1 bigint, first bigint, ids string")
    together = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_node, state = None, None
        for batch in batches:
            made = []
            for *node, ids in zip(*[batch[c] for c in (*NODE, "ids")]):
                if node != open_node:
                    if open_node is not None:
                        made.append((*open_node, state.hexdigest()))
                    open_node, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pd.DataFrame(made, columns=[*NODE, "ends_sha256"])
        if open_node is not None:
            yield pd.DataFrame([(*open_node, state.hexdigest())], columns=[*NODE, "ends_sha256"])

    return together.mapInPandas(digest, "depth bigint, f0 bigint, f1 bigint, ends_sha256 string")


def below(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with the sums of leaves and saved code points over their subtrees.

    A node belongs to its smallest member, and the nodes of one member follow each other down
    to its end. A subtree is the rest of its owner's run and the whole runs of the other
    members that start below it: a sum along each run and one sum over members, however deep
    the trie.
    """
    weights = nodes.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_chars")).alias("weight"),
        (F.col("ends") == F.col("n_convs")).cast("bigint").alias("leaf"), (-F.col("depth")).alias("up"),
    )
    sums = {"own_saved": F.col("weight"), "own_leaves": F.col("leaf")}
    own = running_sums(weights, ["conv_id"], ["up"], sums, "runs").select("conv_id", "depth", *sums)
    runs = weights.groupBy("conv_id").agg(
        F.min("depth").alias("start"), F.sum("weight").alias("run_saved"), F.sum("leaf").alias("run_leaves")
    ).where("start > 0 AND (run_saved > 0 OR run_leaves > 0)")
    above = rows.select("conv_id", *NODE).join(runs, "conv_id").where("depth < start")
    other = above.groupBy(*NODE).agg(F.sum("run_saved").alias("run_saved"), F.sum("run_leaves").alias("run_leaves"))
    return nodes.join(own, ["conv_id", "depth"]).join(other, NODE, "left").withColumns({
        "saved_tokens": F.col("own_saved") + F.coalesce("run_saved", F.lit(0)),
        "n_leaves": F.col("own_leaves") + F.coalesce("run_leaves", F.lit(0)),
    }).drop("own_saved", "own_leaves", "run_saved", "run_leaves")


def prefix_trie(conversations: DataFrame, recipes: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations.

    ``recipes`` (conv_id, base_id, head, one row per conversation) says that a conversation is
    the first ``head`` turns of ``base_id`` and then its own turns after its first ``head``.
    Returns one row per distinct sequence of first turns: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and the stored turn
    (turn_conv_id, turn_index from 1) that is its last one.

    Defined results: null turns come first, turns with the same number are ordered by role and
    text, repeated rows are turns of their own, null roles and texts are empty, rows without a
    conv_id are left out, a head longer than its base is the whole base, an absent base gives
    nothing. No conversations give no nodes. Other columns are not read.
    """
    turns = plain_turns(conversations)
    for attempt in range(ATTEMPTS):
        if not turns_agree(turns, attempt):
            continue
        sums = prefix_sums(turns, attempt)
        rows = prefixes(planned(recipes, sums), sums, attempt)
        nodes = grouped(rows)
        if nodes.where("NOT agree").isEmpty():
            break
    else:
        raise RuntimeError(f"{ATTEMPTS} pairs of bases left different turns with equal fingerprints")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p0").alias("f0"), F.col("p1").alias("f1")).agg(
        F.count("*").alias("n_children")
    )
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("f0").alias("p0"), F.col("f1").alias("p1"), F.col("conv_id").alias("parent_conv_id")
    )
    whole = below(rows, nodes).join(children, NODE, "left").join(end_digests(rows), NODE, "left")
    return whole.join(parents, ["depth", "p0", "p1"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"),
        "turn_conv_id", "turn_index",
    )


def hundreds(conversations: DataFrame, spacing: int = 100, heads: int = 6) -> DataFrame:
    """Recipes: the base is the id rounded down (towards zero) to ``spacing``, the head a checksum of the id modulo ``heads``."""
    ids = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
    return ids.select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % spacing).alias("base_id"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).cast("bigint").alias("head"),
    )


def report(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as ``hundreds`` rebuilds them."""
    return prefix_trie(conversations, hundreds(conversations))
