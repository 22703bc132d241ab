"""Words of a text as column expressions, tables that cut lineage, joins to small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

SPACES = " \t\n\x0b\x0c\r"  # U+0020 and U+0009 to U+000D
GAP = "[ \\x09-\\x0D]+"
BROADCAST_BYTES = 64 << 20
NO_WORDS = "CAST(array() AS array<string>)"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def words_of(text: str | Column) -> Column:
    """The maximal runs of characters other than white space; null and blank texts have none."""
    column = F.col(text) if isinstance(text, str) else text
    trimmed = F.btrim(column, F.lit(SPACES))
    return F.when(F.length(trimmed) > 0, F.split(trimmed, GAP)).otherwise(F.expr(NO_WORDS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back.

    A lost executor then costs a read and not the work before it, and plans that use the
    rows twice do that work once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_few(
    facts: DataFrame, few: DataFrame, keys: Sequence[str], row_bytes: int = 64, how: str = "left",
    limit: int = BROADCAST_BYTES, salts: int = 32,
) -> DataFrame:
    """Joins facts to a stored table with one row per key.

    The table's rows are counted: under ``limit`` bytes it is broadcast. Beyond that it is
    copied ``salts`` times and the facts' keys are salted with their row's hash, so that the
    rows of one key spread over as many tasks.
    """
    if few.count() * row_bytes <= limit:
        return facts.join(F.broadcast(few), list(keys), how)
    plain = [F.col(c) for c, kind in facts.dtypes if not kind.startswith("map")]
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*plain, F.monotonically_increasing_id()), F.lit(salts)))
    right = few.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).cast("bigint"))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def keyed(docs: DataFrame, text: str = "text") -> tuple[DataFrame, bool]:
    """The rows with a ``_key`` in the order of documents, and whether ids were unique.

    Unique ids are the keys. Otherwise the key is the rank of (id, hash of the text), rows
    without an id last; rows that share both have one key.
    """
    plain = docs.withColumn("_key", F.col("doc_id").cast("bigint"))
    shared = plain.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1 OR _key IS NULL")
    if shared.isEmpty():
        return plain, True
    order = ["_none", "_id", "_tie"]
    tied = plain.drop("_key").withColumns({
        "_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
        "_tie": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    })
    pinned = stored(tied.select(*order).distinct().repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row per task
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranks = pinned.join(F.broadcast(before), "_part").select(*order, (F.col("_before") + place).alias("_key"))
    return stored(tied.join(ranks, order).drop(*order), "ranked-rows"), False


def join_lists(facts: DataFrame, lists: DataFrame, key: str, column: str, how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """Joins facts to a stored table of one list of numbers per key; broadcast if the lists are few."""
    taken = lists.agg(F.sum(F.size(column) * 8 + 64)).first()[0] or 0
    return facts.join(F.broadcast(lists) if taken <= limit else lists, key, how)
