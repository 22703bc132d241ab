"""Pin source files by size, hash and shape."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20


def _hash_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each listed file, read in chunks by the task that owns the file."""
    from pyarrow import fs

    for batch in batches:
        digests = []
        for uri in batch["path"]:
            system, name = fs.FileSystem.from_uri(uri)
            digest = hashlib.sha256()
            with system.open_input_stream(name) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pd.DataFrame({"path": batch["path"], "bytes": batch["bytes"], "sha256": digests})


def file_manifest(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """path, bytes, sha256 of every file; files are spread over the tasks."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        .select("path", F.col("length").alias("bytes"))
        # A fixed number of tasks: sized by these short rows, they would be merged into one.
        .repartition(4 * spark.sparkContext.defaultParallelism, "path")
    )
    return listed.mapInPandas(_hash_files, "path string, bytes long, sha256 string")


def manifest_check(spark: SparkSession, path: str, expected: DataFrame, glob: str = "*.parquet") -> DataFrame:
    """Expected (path, bytes, sha256) beside what is there; ``matches`` per file."""
    actual = file_manifest(spark, path, glob).select(
        "path", F.col("bytes").alias("actual_bytes"), F.col("sha256").alias("actual_sha256"),
    )
    return expected.join(actual, "path", "full").withColumn(
        "matches",
        F.col("bytes").eqNullSafe(F.col("actual_bytes")) & F.col("sha256").eqNullSafe(F.col("actual_sha256")),
    )


def verify_files(spark: SparkSession, path: str, expected: DataFrame, glob: str = "*.parquet") -> None:
    """Raise with the files whose size or hash differs."""
    bad = [r["path"] for r in manifest_check(spark, path, expected, glob).where(~F.col("matches")).collect()]
    if bad:
        raise ValueError(f"files differ from the manifest: {sorted(bad)}")


FOOTER = "path string, bytes long, row_count long, column_count int, columns array<struct<name: string, type: string, nulls: long, low: string, high: string>>"


def _read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, columns, null counts and extremes of each listed Parquet file, from its footer alone."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    for batch in batches:
        made = []
        for uri, size in zip(batch["path"], batch["bytes"]):
            system, name = fs.FileSystem.from_uri(uri)
            with system.open_input_file(name) as source:
                footer = pq.read_metadata(source)
            columns = []
            for i in range(footer.num_columns):
                chunks = [footer.row_group(g).column(i) for g in range(footer.num_row_groups)]
                stats = [c.statistics for c in chunks]
                known = all(x is not None and x.has_null_count for x in stats)
                ranged = [x for x in stats if x is not None and x.has_min_max]
                complete = ranged and len(ranged) == len(chunks)
                columns.append({
                    "name": footer.schema.column(i).path, "type": footer.schema.column(i).physical_type,
                    "nulls": sum(x.null_count for x in stats) if known else None,
                    "low": str(min(x.min for x in ranged)) if complete else None,
                    "high": str(max(x.max for x in ranged)) if complete else None,
                })
            made.append((uri, size, footer.num_rows, footer.num_columns, columns))
        yield pd.DataFrame(made, columns=["path", "bytes", "row_count", "column_count", "columns"])


def footer_manifest(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """path, bytes, row_count, column_count and per column its type, nulls and extremes.

    No data page is read: a file costs its footer, and files are spread over the tasks. Row
    counts, expected rows and null profiles of whole tables are sums over this table. A
    column's nulls or extremes are null where a row group has no statistics.
    """
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
        .select("path", F.col("length").alias("bytes")).repartition(4 * spark.sparkContext.defaultParallelism, "path")
    )
    return listed.mapInPandas(_read_footers, FOOTER)


def pin(spark: SparkSession, path: str, kept: str, glob: str = "*.parquet") -> DataFrame:
    """Writes sizes, hashes and footers of the files to ``kept``, for later runs to compare with."""
    both = file_manifest(spark, path, glob).join(footer_manifest(spark, path, glob).drop("bytes"), "path")
    both.write.parquet(kept)
    return spark.read.parquet(kept)


def compare_with_pinned(spark: SparkSession, path: str, kept: str, glob: str = "*.parquet") -> DataFrame:
    """Every file of the pinned manifest or the folder: path, status, and both sides' sizes, hashes and rows.

    ``status`` is same, changed, added or missing. A file with the pinned hash is the same
    whatever its age.
    """
    names = ["bytes", "sha256", "row_count"]
    old = spark.read.parquet(kept).select("path", *[F.col(c).alias(f"pinned_{c}") for c in names])
    new = file_manifest(spark, path, glob).join(footer_manifest(spark, path, glob).select("path", "row_count"), "path")
    same = F.col("bytes").eqNullSafe(F.col("pinned_bytes")) & F.col("sha256").eqNullSafe(F.col("pinned_sha256"))
    status = F.when(F.col("pinned_bytes").isNull(), "added").when(F.col("bytes").isNull(), "missing").when(same, "same").otherwise("changed")
    return old.join(new, "path", "full").select("path", status.alias("status"), *[c for n in names for c in (f"pinned_{n}", n)])
