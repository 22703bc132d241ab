"""Running sums along an order, of whole tables or of groups of any length."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def running_sums(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, Column], name: str = "ordered",
    partitions: int | None = None,
) -> DataFrame:
    """Adds the sums of ``sums`` over the rows up to and with each one, in ``order`` inside ``group``.

    Rows are range-partitioned by group and order, so a group with a third of all rows spreads
    over as many tasks as its rows need; the partition becomes a column of a written table.
    Sums run inside (partition, group). Only groups that touch the edge of a partition can
    continue in the next one: two rows a partition carry their totals, which are broadcast.
    Group columns must not be null. Rows that tie in the whole order are numbered in any order.
    """
    by = [*group, *order]
    dealt = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    pinned = stored(dealt.withColumn("_stretch", F.spark_partition_id()), name)
    inside = Window.partitionBy("_stretch", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = pinned.withColumns({k: F.sum(v).over(inside) for k, v in sums.items()})
    carried = pinned
    if group:
        key = F.struct(*group)
        edges = pinned.groupBy("_stretch").agg(F.min(key).alias("low"), F.max(key).alias("high"))
        edge = edges.select("low.*").union(edges.select("high.*")).distinct()
        carried = pinned.join(F.broadcast(edge), list(group), "left_semi")
    totals = carried.groupBy("_stretch", *group).agg(*[F.sum(v).alias(f"_{k}") for k, v in sums.items()])
    before = Window.partitionBy(*group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select("_stretch", *group, *[F.sum(f"_{k}").over(before).alias(f"_{k}") for k in sums])
    joined = local.join(F.broadcast(carry), ["_stretch", *group], "left")
    whole = {k: F.col(k) + F.coalesce(F.col(f"_{k}"), F.lit(0)) for k in sums}
    return joined.withColumns(whole).drop("_stretch", *[f"_{k}" for k in sums])


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
