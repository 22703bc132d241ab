"""The operators' roles bound to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.expressions import duration
from ledgerline.functions.hashing import split_hash
from ledgerline.operators.splits import split_column
from ledgerline.sources.tables import table

TRIP_IDS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
DAY = 86_400.0

_LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]

# The same views as text for the SQL side.
TRIP_SQL = """trip AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, o_orderdate AS started_at, l_shipdate AS ended_at,
         o_orderpriority, o_totalprice,
         l_extendedprice * (1 - l_discount) AS net,
         l_extendedprice * (1 - l_discount) * l_tax AS tax,
         l_extendedprice * (1 - l_discount) * (1 + l_tax) AS amount,
         (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0 AS days
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

TRIP_NULLS_SQL = TRIP_SQL + """, trip_nulls AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_discount, l_linestatus,
         started_at, ended_at, o_orderpriority, o_totalprice, net, tax, amount, days,
         CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
         CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_tax END AS l_tax,
         CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag
  FROM trip)"""

HASH_SQL = "('0x' || substr(md5('42:' || {ids}), 1, 15))::BIGINT"
EVENT_HASH_SQL = HASH_SQL.format(ids="event_id::VARCHAR")
TRIP_HASH_SQL = HASH_SQL.format(
    ids="l_orderkey::VARCHAR || ':' || l_linenumber::VARCHAR || ':' || l_partkey::VARCHAR || ':' || l_suppkey::VARCHAR"
)

EVENTS_SPLIT_SQL = f"""events_split AS (
  SELECT event_id, ts, user_id, event_type, value, h,
         CASE WHEN h % 10 < 2 THEN 'test' ELSE 'train' END AS split,
         h % 5 AS fold
  FROM (SELECT *, {EVENT_HASH_SQL} AS h FROM events) hashed)"""


def trip(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem joined to its order, with period, duration in days, net, tax and amount."""
    lines = table(spark, folder, "lineitem").select(*_LINE_COLUMNS)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("started_at"),
        "o_orderpriority",
        "o_totalprice",
    )
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return lines.join(orders, "l_orderkey").select(
        *_LINE_COLUMNS[:-1],
        "started_at",
        F.col("l_shipdate").alias("ended_at"),
        "o_orderpriority",
        "o_totalprice",
        net.alias("net"),
        (net * F.col("l_tax")).alias("tax"),
        (net * (1 + F.col("l_tax"))).alias("amount"),
        duration("started_at", "l_shipdate", DAY).alias("days"),
    )


def trip_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """trip with keyed nulls in quantity and tax (together) and in the return flag."""
    seventh, eleventh = F.col("l_partkey") % 7 == 0, F.col("l_partkey") % 11 == 0
    return trip(spark, folder).withColumns({
        "l_quantity": F.when(~seventh, F.col("l_quantity")),
        "l_tax": F.when(~seventh, F.col("l_tax")),
        "l_returnflag": F.when(~eleventh, F.col("l_returnflag")),
    })


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


def events_split(spark: SparkSession, folder: str) -> DataFrame:
    """events with a hash split and a hash fold."""
    h = split_hash(["event_id"], 42)
    return events(spark, folder).select("event_id", "ts", "user_id", "event_type", "value", h.alias("h")).select(
        "*",
        split_column(F.pmod("h", F.lit(10)) < 2).alias("split"),
        F.pmod("h", F.lit(5)).cast("int").alias("fold"),
    )
