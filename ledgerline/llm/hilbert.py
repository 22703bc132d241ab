"""Shards along a Hilbert curve through several metadata columns.

Each column is cut into cells of about equal numbers of rows, the cells of a row are a point
of a grid, and rows are sorted by the point's place on the Hilbert curve through the grid.
Neighbours on the curve are neighbours in every column, so a run of it covers a small box:
a reader that filters by any of the columns skips the files whose box it misses.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.llm.ordered import running_sums

DIMENSIONS = ("source", "lang", "size", "doc_id")
BITS = 6  # 64 cells a column
BOUNDARY = 256  # code points of a string that a cell's boundary keeps
SHARDS = 16
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp")


def curve_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each point, a column of ``cells`` (dimensions by points).

    From the highest bit down, the sub-cube a point lies in tells how the curve is turned
    there: the first coordinate's lower bits are inverted, or exchanged with another's.
    What is left is the Gray code of the place.
    """
    x = cells.astype(np.int64).copy()
    one = np.int64(1)
    for bit in range(bits - 1, 0, -1):
        lower = (one << bit) - one
        for axis in range(len(x)):
            high = (x[axis] >> bit) & one == 1
            swap = np.where(high, 0, (x[0] ^ x[axis]) & lower)
            x[0] ^= np.where(high, lower, swap)
            x[axis] ^= swap
    for axis in range(1, len(x)):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flips ^= np.where((x[-1] >> bit) & one == 1, (one << bit) - one, 0)
    x ^= flips
    place = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in range(len(x)):
            place = place << one | (x[axis] >> bit) & one
    return place


def boundaries(rows: DataFrame, column: str, bits: int) -> list:
    """Sorted values, fewer than 2^bits, of which a value's cell is the number that do not exceed it.

    Cells hold about equal numbers of rows; a value with more rows than a cell repeats in the
    list, so the cells of few values lie as far apart as their rows. Numbers are cut at quantiles
    from a mergeable sketch of all rows. Other values are counted, and a cell begins at the
    first value behind each equal share of the rows.
    """
    cells = 1 << bits
    if dict(rows.dtypes)[column].split("(")[0] in NUMBERS:
        shares = [i / cells for i in range(1, cells)]
        found = rows.agg(F.percentile_approx(F.col(column).cast("double"), shares, 10_000)).first()[0]
        return list(found or [])
    value = F.col(column).cast("string")
    counts = rows.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))
    summed = running_sums(counts, [], ["value"], {"upto": F.col("n")}, "values")
    total = summed.agg(F.max("upto")).first()[0] or 0
    cell = F.floor((F.col("upto") - F.col("n")) * cells / F.lit(max(total, 1)))
    firsts = summed.groupBy(cell.alias("cell")).agg(F.min("value").alias("value"))
    cuts: list[str] = []
    for row in sorted(firsts.collect()):  # a row per cell
        cuts += [row["value"][:BOUNDARY]] * (row["cell"] - len(cuts))
    return cuts


def on_curve(rows: DataFrame, dimensions: Sequence[str], bits: int) -> Column:
    """Column with each row's place on the curve; nulls lie in a cell's first place, before all values."""
    cuts = [boundaries(rows, d, bits) for d in dimensions]
    kinds = dict(rows.dtypes)
    numeric = [kinds[d].split("(")[0] in NUMBERS for d in dimensions]

    @F.pandas_udf("bigint")
    def place(*columns: pd.Series) -> pd.Series:
        cells = np.zeros((len(columns), len(columns[0])), np.int64)
        for i, (column, cut, number) in enumerate(zip(columns, cuts, numeric)):
            known = column.notna().to_numpy()
            if cut and number:
                cells[i, known] = np.searchsorted(np.array(cut, np.float64), column[known].to_numpy(np.float64), "right")
            elif cut:
                codes, values = pd.factorize(column[known])
                places = np.array([np.searchsorted(np.array(cut, object), v, "right") for v in values], np.int64)
                cells[i, known] = places[codes] if len(places) else 0
        return pd.Series(curve_index(np.minimum(cells, (1 << bits) - 1), bits))

    return place(*[F.col(d).cast("double" if n else "string") for d, n in zip(dimensions, numeric)])


def described() -> list[Column]:
    """doc_id, source, lang, and of the text its size, checksum and hash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source"), F.col("lang"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    ]


def cut_runs(rows: DataFrame, key: Sequence[str], shards: int) -> DataFrame:
    """Adds shard and slot: the rows in the order of ``key``, cut into runs of equal length.

    A shard's number of rows differs by one at most from another's, and slots count from 0.
    """
    total = rows.count()
    placed = running_sums(rows, [], key, {"place": F.lit(1).cast("bigint")}, "on-curve")
    place = F.col("place") - 1
    run = F.floor(place * shards / F.lit(max(total, 1)).cast("decimal(20,0)")).cast("bigint")
    first = F.ceil(F.col("run") * total / F.lit(shards).cast("decimal(20,0)")).cast("bigint")
    return placed.withColumn("run", run).withColumns(
        {"slot": place - first, "shard": F.col("run").cast("int")}
    ).drop("run", "place")


def shards(docs: DataFrame, count: int = SHARDS, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """doc_id, source, lang, size, text_crc32, curve, shard and slot of every document.

    Rows are ordered by curve, then by a hash of the text, so that equal texts of one cell
    follow each other, then by doc_id. Texts are read once and not shuffled.

    Defined results: a null text is empty and has size 1; nulls of a dimension share the first
    cell with its smallest values; repeated rows take a place each; fewer documents than
    shards leave shards empty; no documents give no rows. Any text length is one row of some
    bytes here. Other columns are not read.
    """
    rows = stored(docs.select(*described()), "described")
    curved = rows.withColumn("curve", on_curve(rows, dimensions, bits))
    return cut_runs(curved, ["curve", "text_hash", "doc_id"], count).drop("text_hash")


def write_shards(docs: DataFrame, path: str, count: int = SHARDS, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS) -> DataFrame:
    """Writes whole documents as Parquet in folders ``shard=N``, in the order of the curve.

    Returns one row per shard with its rows, bytes and the least and largest value of every
    dimension: what a reader needs to skip shards. The file's statistics say the same.
    """
    flat = stored(docs.select(F.struct("*").alias("row"), *described()), "described-rows")
    curved = flat.withColumn("curve", on_curve(flat, dimensions, bits))
    placed = stored(cut_runs(curved, ["curve", "text_hash", "doc_id"], count), "cut-rows")
    placed.select("row.*", "shard").repartition(count, "shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return boxes(placed, dimensions)


def boxes(placed: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Rows, bytes and range of every dimension per shard."""
    ranges = [f(d).alias(f"{name}_{d}") for d in dimensions for name, f in (("least", F.min), ("most", F.max))]
    return placed.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *ranges)


def report(docs: DataFrame) -> DataFrame:
    """Shard and slot of every document under the law of equal row counts."""
    return shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )
