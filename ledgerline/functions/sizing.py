"""Checked sizes: what may be broadcast, and the other way beyond it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000  # so that even 10^12 rows have few hot keys
HOT_KEY_BYTES, HOT_LIST_BYTES = 256, 32 << 20
FIT_PARTITIONS = 8
FIT_PARTITION_BYTES = 128 << 20
UNKNOWN_BYTES = 1 << 60


def measured(table: DataFrame) -> DataFrame:
    """Cache a small aggregate and count it, so that its true size is known."""
    return measured_rows(table)[0]


def measured_rows(table: DataFrame) -> tuple[DataFrame, int]:
    """The cached aggregate and its row count."""
    cached = table.persist(StorageLevel.MEMORY_AND_DISK)
    return cached, cached.count()


def scanned_bytes(df: DataFrame) -> int:
    """Size of everything the plan reads, from file metadata."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt by their hash over a number of partitions that the input's size alone sets.

    Learners draw samples partition by partition in row order, so the rows are also sorted
    by the hash: the same table gives the same model on any cluster.
    """
    size = scanned_bytes(df)
    if size >= UNKNOWN_BYTES:  # rows that come from no file
        size = df.count() * 16 * len(df.columns)
    parts = FIT_PARTITIONS + size // FIT_PARTITION_BYTES
    place = F.xxhash64(*[F.col(c) for c in df.columns])
    dealt = df.withColumn("_place", place).repartition(parts, "_place")
    return dealt.sortWithinPartitions("_place").drop("_place")


def spread_small(df: DataFrame) -> DataFrame:
    """``spread`` for small inputs, so that all cores work on them; larger ones have partitions
    enough and are not shuffled and sorted again. For learners that add up all rows."""
    size = scanned_bytes(df)
    return spread(df) if size < FIT_PARTITION_BYTES or size >= UNKNOWN_BYTES else df


def known_bytes(table: DataFrame) -> int:
    """Planner's size of a table; exact for a measured one."""
    return int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(table: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` of the session in bytes."""
    session_state = table.sparkSession._jsparkSession.sessionState()
    return int(session_state.conf().autoBroadcastJoinThreshold())


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a measured table is within the session's broadcast limit."""
    return known_bytes(table) <= broadcast_limit(table)


def lookup_join(
    facts: DataFrame, table: DataFrame, on: Sequence[str], salts: int = 64, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Left join to a measured table with one row per key.

    Within the broadcast limit the table is broadcast. Beyond it the join shuffles by key,
    and only the keys that hold over ``hot_rows`` fact rows are salted: their fact rows
    spread over ``salts`` copies of the table's row. Null keys, which match nothing, spread
    as well. Equal rows get different salts too; whatever a row's salt is, it meets its
    table row exactly once, so a repeated task gives the same rows.
    """
    keys = list(on)
    if fits_broadcast(table):
        return facts.join(F.broadcast(table), keys, "left")
    counts = facts.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = measured(counts.where(F.col("_rows") > hot_rows).select(*keys, F.lit(True).alias("_hot")))
    if hot.count() * HOT_KEY_BYTES <= max(broadcast_limit(table), HOT_LIST_BYTES):
        hot = F.broadcast(hot)
    row_salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    no_key = reduce(or_, [F.col(k).isNull() for k in keys])
    left = facts.join(hot, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot") | no_key, row_salt).otherwise(0)
    ).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.join(hot, keys, "left").withColumn("_copies", copies).drop("_hot").withColumn(
        "_salt", F.explode("_copies")
    ).drop("_copies")
    return left.join(right, [*keys, "_salt"], "left").drop("_salt")
