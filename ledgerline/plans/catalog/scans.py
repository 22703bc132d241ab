"""Reads, row ids, manifests, and written tables read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.plans.bindings import TRIP_IDS, events
from ledgerline.plans.registry import query
from ledgerline.session import scratch_path
from ledgerline.sources import manifest, sinks, tables


@query("scan_parquet", "SELECT * FROM customer")
def scan_parquet(spark, folder):
    return tables.scan_parquet(spark, f"{folder}/customer.parquet")


@query("scan_pruned", "SELECT l_orderkey, l_quantity, l_discount, l_returnflag FROM lineitem")
def scan_pruned(spark, folder):
    wanted = ["l_orderkey", "l_quantity", "l_discount", "l_returnflag"]
    return tables.scan_pruned(spark, f"{folder}/lineitem.parquet", wanted)


@query("stable_row_id", f"""
SELECT row_number() OVER () - 1 AS source_row_id, {', '.join(TRIP_IDS)} FROM lineitem
""")
def stable_row_id(spark, folder):
    return tables.scan_with_row_id(spark, f"{folder}/lineitem.parquet").select("source_row_id", *TRIP_IDS)


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
_MANIFEST_SQL = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file, true AS matches, (SELECT count(*) FROM {t}) AS row_count, "
    f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS column_count"
    for t in _TABLES
)


@query("manifest_check", _MANIFEST_SQL)
def manifest_check(spark, folder):
    """Each table's files against the manifest written before, with its rows and columns."""
    path = scratch_path(spark, "manifest")
    manifest.file_manifest(spark, folder).select("path", "bytes", "sha256").write.parquet(path)
    files = manifest.manifest_check(spark, folder, spark.read.parquet(path))
    name = F.regexp_extract("path", r"/(\w+\.parquet)(/|$)", 1)
    same = files.groupBy(name.alias("file")).agg(F.bool_and("matches").alias("matches"))
    shapes = None
    for t in _TABLES:
        rows = tables.table(spark, folder, t)
        shape = rows.agg(F.count("*").alias("row_count")).select(
            F.lit(f"{t}.parquet").alias("file"), "row_count", F.lit(len(rows.columns)).cast("bigint").alias("column_count"))
        shapes = shape if shapes is None else shapes.unionByName(shape)
    return same.join(shapes, "file").select("file", "matches", "row_count", "column_count")


def _named(spark, folder, target, tables_, edit=lambda df: df):
    """Tables of the folder as single files ``<table>.parquet`` under ``target``, replaced if there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    for t in tables_:
        made = scratch_path(spark, t)
        edit(tables.table(spark, folder, t)).coalesce(1).write.parquet(made)
        part = next(f for f in spark.read.parquet(made).inputFiles())
        system.mkdirs(path(target))
        system.delete(path(f"{target}/{t}.parquet"), False)
        system.rename(path(part), path(f"{target}/{t}.parquet"))


@query("pinned_manifest", """
SELECT 'nation.parquet' AS file, 'same' AS status, count(*) AS pinned_rows, count(*) AS row_count, false AS other_hash FROM nation
UNION ALL SELECT 'supplier.parquet', 'changed', count(*), count(*) FILTER (WHERE s_suppkey > 3), true FROM supplier
UNION ALL SELECT 'customer.parquet', 'added', NULL, count(*), NULL FROM customer
UNION ALL SELECT 'region.parquet', 'missing', count(*), NULL, NULL FROM region
""")
def pinned_manifest(spark, folder):
    """A copy of three tables is pinned; then one loses rows, one goes and a fourth comes."""
    target, kept = scratch_path(spark, "files"), scratch_path(spark, "pinned")
    _named(spark, folder, target, ["nation", "supplier", "region"])
    manifest.pin(spark, target, kept)
    _named(spark, folder, target, ["supplier"], lambda df: df.where("s_suppkey > 3"))
    _named(spark, folder, target, ["customer"])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/region.parquet")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    files = manifest.compare_with_pinned(spark, target, kept)
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "status", F.col("pinned_row_count").alias("pinned_rows"),
        "row_count", (F.col("sha256") != F.col("pinned_sha256")).alias("other_hash"),
    )


@query("footer_profile", """
SELECT 'orders.parquet' AS file, count(*) AS row_count, CAST((SELECT count(*) FROM information_schema.columns WHERE table_name = 'orders') AS INTEGER) AS column_count,
       count(*) - count(o_orderkey) AS null_keys, CAST(min(o_orderkey) AS VARCHAR) AS low_key, CAST(max(o_orderkey) AS VARCHAR) AS high_key FROM orders
""")
def footer_profile(spark, folder):
    """Rows, columns, nulls and range of the order key from the footers."""
    files = manifest.footer_manifest(spark, folder, "orders*")
    key = F.filter("columns", lambda c: c["name"] == "o_orderkey")[0]
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file"), "row_count", "column_count",
        key["nulls"].alias("null_keys"), key["low"].alias("low_key"), key["high"].alias("high_key"),
    )


_DAILY_SQL = """
SELECT CAST(event_type AS VARCHAR) AS event_type, CAST(user_id AS BIGINT) AS user_id,
       count(*) AS row_count, avg(value) AS mean_value FROM events GROUP BY 1, 2
"""


def _user_totals(spark, folder):
    return events(spark, folder).groupBy("event_type", "user_id").agg(
        F.count("*").alias("row_count"), F.avg("value").alias("mean_value")
    )


@query("sink_parquet", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net FROM lineitem
""", rounded="net")
def sink_parquet(spark, folder):
    net = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net")
    lines = tables.table(spark, folder, "lineitem").select(*TRIP_IDS, net)
    return sinks.sink_parquet(lines, scratch_path(spark, "net"))


@query("sink_csv", _DAILY_SQL, rounded="mean_value")
def sink_csv(spark, folder):
    return sinks.sink_csv(_user_totals(spark, folder), scratch_path(spark, "totals-csv"))


@query("sink_json", _DAILY_SQL, rounded="mean_value")
def sink_json(spark, folder):
    return sinks.sink_json(_user_totals(spark, folder), scratch_path(spark, "totals-json"))
