"""Bottom-k sketches of shingle hashes, and what they estimate.

A sketch is the k smallest distinct 48-bit hashes of a text's five-word shingles (all words,
if fewer), in ascending order. The sketch of a union is the k smallest of its parts'
values, so parts can be sketched apart and merged. From two sketches follow the
resemblance and the containment of the shingle sets, from one the number of shingles.

Only column functions run. Defined results: null, empty and blank texts have no shingle and
the empty sketch; two empty sketches resemble each other fully, an empty and another one not
at all. Equal texts have equal sketches. Documents without an id have no place in the order
of documents: the empty text counts as their next. Documents with one id are ordered by
their texts' hashes. An empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import join_few, stored, words_of

SKETCH_SIZE = 256
SHINGLE_WORDS = 5
HASH_SPACE = float(1 << 48)
BLOCK_BITS = 12
NO_HASHES = "CAST(array() AS array<bigint>)"


def with_sketch(df: DataFrame, text: str, sketch: str, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS) -> DataFrame:
    """Adds the sketch of a text column.

    Words are hashed once; a shingle's hash is the hash of its words' hashes.
    """
    picked = ", ".join(f"_wh[i + {j}]" for j in range(words))
    hashes = f"""CASE WHEN size(_wh) = 0 THEN {NO_HASHES}
        WHEN size(_wh) < {words} THEN array(shiftrightunsigned(xxhash64(_wh), 16))
        ELSE transform(sequence(0, size(_wh) - {words}), i -> shiftrightunsigned(xxhash64({picked}), 16)) END"""
    hashed = df.withColumn("_wh", F.transform(words_of(text), lambda w: F.xxhash64(w)))
    return hashed.withColumn(sketch, F.expr(f"slice(sort_array(array_distinct({hashes})), 1, {k})")).drop("_wh")


def merge_sketches(df: DataFrame, keys: Sequence[str], sketch: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One merged sketch per group of parts. Values are made distinct first; of each group's, a task
    of the last step keeps k."""
    keys = list(keys)
    ranked = Window.partitionBy(*keys).orderBy("_value")
    values = df.select(*keys, F.explode_outer(sketch).alias("_value")).distinct()
    least = values.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") <= k)
    return least.groupBy(*keys).agg(F.sort_array(F.collect_list("_value")).alias(sketch))


def resemblance(a: str, b: str, k: int = SKETCH_SIZE) -> Column:
    """Share of common shingles among all shingles of two texts, from their sketches."""
    union = f"slice(sort_array(array_union({a}, {b})), 1, {k})"
    common = f"size(array_intersect({union}, array_intersect({a}, {b})))"
    return F.expr(f"CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D "
                  f"ELSE CAST({common} AS double) / least({k}, size(array_union({a}, {b}))) END")


def distinct_shingles(sketch: str, k: int = SKETCH_SIZE) -> Column:
    """Number of distinct shingles: exact below k, else (k - 1) over the largest value's share."""
    return F.expr(f"CASE WHEN size({sketch}) < {k} THEN CAST(size({sketch}) AS double) "
                  f"ELSE ({k} - 1) * {HASH_SPACE}D / element_at({sketch}, {k}) END")


def containment(a: str, b: str, k: int = SKETCH_SIZE) -> Column:
    """Share of the first text's shingles that the second has; 1 if the first has none."""
    j = resemblance(a, b, k)
    common = j / (1 + j) * (distinct_shingles(a, k) + distinct_shingles(b, k))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def as_text(sketch: str) -> Column:
    """Twelve hexadecimal digits per value."""
    return F.expr(f"array_join(transform({sketch}, x -> lpad(lower(hex(x)), 12, '0')), '')")


def _blocks_below(docs: DataFrame) -> DataFrame:
    """(doc_id, _to): the largest document of each block of ids, and the block that follows it.

    A block holds 2^BLOCK_BITS consecutive ids. Blocks are ranged over tasks and stored, which
    pins them; the edges between the ranges are one row per task. The last block in
    descending order is followed by the first.
    """
    blocks = docs.where(F.col("doc_id").isNotNull()).groupBy("_block").agg(F.max("doc_id").alias("doc_id"))
    ranged = stored(blocks.repartitionByRange("_block").withColumn("_part", F.spark_partition_id()), "blocks")
    inside = ranged.withColumn("_below", F.lag("doc_id").over(Window.partitionBy("_part").orderBy("_block")))
    parts = ranged.groupBy("_part").agg(F.max("doc_id").alias("_last"))
    by_part = Window.orderBy("_part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = parts.select("_part", F.coalesce(F.lag("_last").over(by_part), F.max("_last").over(whole)).alias("_edge"))
    found = inside.join(F.broadcast(edges), "_part")  # a row per task of the shuffle
    return found.select(F.coalesce("_below", "_edge").alias("doc_id"), F.col("_block").alias("_to"))


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """(doc_id, text, _next) in descending order of ids, and the window to look ahead with.

    Documents are shuffled once, by blocks of ids; the document that follows a block in
    descending order is copied to its end. Rows with ``_extra`` are such copies, to be
    dropped once nothing more is looked up.
    """
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("_block", F.expr(f"shiftright(doc_id, {BLOCK_BITS})"))
    links = stored(_blocks_below(placed.select("doc_id", "_block")), "block-links")
    copied = (
        join_few(placed, links.groupBy("doc_id").agg(F.collect_list("_to").alias("_to")), ["doc_id"])
        .withColumn("_place", F.explode(F.concat(
            F.array(F.struct(F.col("_block").alias("b"), F.lit(False).alias("extra"))),
            F.expr("coalesce(transform(_to, t -> struct(t AS b, true AS extra)), array())"),
        )))
        .select("doc_id", "text", F.col("_place.b").alias("_block"), F.col("_place.extra").alias("_extra"))
        .withColumn("_tie", F.xxhash64("text"))
    )
    # Documents without an id are windows of their own.
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    ahead = Window.partitionBy("_block", "_alone").orderBy("_extra", F.col("doc_id").desc(), "_tie")
    ordered = copied.withColumn("_alone", alone)
    return ordered.withColumn("_next", F.coalesce(F.lead("text").over(ahead), F.lit(""))), ahead


def fingerprint_edits(docs: DataFrame, k: int = SKETCH_SIZE) -> DataFrame:
    """Fingerprints of each document and of its edited text, and their likeness.

    The edited text has its last floor(n/2) characters replaced by the first as many, or
    all, of the next document in descending order of ids.
    """
    rows, ahead = with_next(docs)
    edited = rows.withColumn("n_chars", F.length("text").cast("bigint")).withColumn(
        "_edited", F.concat(F.expr("substring(text, 1, CAST(n_chars - n_chars DIV 2 AS int))"), F.expr("substring(_next, 1, CAST(n_chars DIV 2 AS int))")),
    )
    sketched = with_sketch(with_sketch(edited, "text", "_a", k), "_edited", "_b", k).select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "_a", "_b",
        "_block", "_alone", "_extra", "_tie",
    )
    looked = sketched.withColumn("_n", F.coalesce(F.lead("_a").over(ahead), F.expr(NO_HASHES)))
    return looked.where(~F.col("_extra")).select(
        "doc_id", "n_chars", "edited_sha256", as_text("_a").alias("fingerprint"), as_text("_b").alias("edited_fingerprint"),
        resemblance("_a", "_b", k).alias("near_edited"), resemblance("_a", "_n", k).alias("near_next"),
        distinct_shingles("_a", k).alias("distinct_shingles"), containment("_a", "_b", k).alias("contained_in_edited"),
    )
