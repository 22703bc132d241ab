"""Running totals over a whole sorted table without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.sizing import measured, measured_rows
from ledgerline.session import use_checkpoints

SMALL_TABLE = 1_000_000  # rows that one task may sort


def running_total(df: DataFrame, order: Sequence[str], amount: str, upto: str,
                  small_table: int = SMALL_TABLE) -> DataFrame:
    """Adds the running sum of ``amount`` in the given order.

    A table of a checked size takes one window. A larger one is range-partitioned and
    checkpointed, which pins each row's block; sums run inside the blocks, and each block is
    shifted by the totals of the blocks before it (one row per block). ``order`` must not
    have ties.
    """
    cached, rows = measured_rows(df)
    if rows <= small_table:
        return cached.withColumn(upto, F.sum(amount).over(Window.orderBy(*order)))
    use_checkpoints(df.sparkSession)
    blocks = cached.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()).checkpoint()
    totals = measured(blocks.groupBy("_block").agg(F.sum(amount).alias("_in_block")))
    before = F.sum("_in_block").over(Window.orderBy("_block")) - F.col("_in_block")
    offsets = totals.select("_block", before.alias("_before"))
    inside = F.sum(amount).over(Window.partitionBy("_block").orderBy(*order))
    return (
        blocks.join(F.broadcast(offsets), "_block")
        .withColumn(upto, F.col("_before") + inside)
        .drop("_block", "_before")
    )
