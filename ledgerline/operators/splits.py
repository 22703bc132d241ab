"""Deterministic random, temporal and k-fold splits from row hashes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.hashing import split_hash, split_key

MAX_BUCKET_DIGITS = 5  # at most 2^20 counters
BUCKET_ROWS = 1 << 15  # rows wanted in a bucket, as long as there are digits


def _bucket_digits(total: int) -> int:
    bits = (total // BUCKET_ROWS).bit_length()
    return min(MAX_BUCKET_DIGITS, max(1, math.ceil(bits / 4)))


def first_by_hash(
    df: DataFrame, ids: Sequence[str], count: int, seed: int, total: int | None = None
) -> Column:
    """Condition that holds for exactly the ``count`` rows with the smallest (hash, ids).

    Rows are counted by leading hash digits, then only the bucket with the boundary row is
    sorted. The result is a comparison with that row, so rows are chosen without a global
    sort. ``ids`` must identify rows; ``total`` is the row count where it is known.
    """
    total = df.count() if total is None else total
    if count <= 0 or count >= total:
        return F.lit(count > 0)
    key = split_key(ids, seed)
    prefix = F.substring(key, 1, _bucket_digits(total))
    counts = df.groupBy(prefix.alias("_bucket")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")
    boundary = (
        counts.withColumn("_before", before)
        .where((F.col("_before") < count) & (F.col("_before") + F.col("_n") >= count))
        .first()
    )
    inside = df.select(key.alias("_h"), *ids).where(F.col("_h").startswith(boundary["_bucket"]))
    edge = (
        inside.withColumn("_rank", F.row_number().over(Window.orderBy("_h", *ids)))
        .where(F.col("_rank") == count - boundary["_before"])
        .first()
    )
    types = dict(df.dtypes)
    last = F.struct(
        F.lit(edge["_h"]).alias("_h"), *[F.lit(edge[c]).cast(types[c]).alias(c) for c in ids]
    )
    return F.struct(key.alias("_h"), *ids) <= last


def split_column(test: Column) -> Column:
    return F.when(test, F.lit("test")).otherwise(F.lit("train"))


def random_split_exact(
    df: DataFrame, ids: Sequence[str], test_size: float = 0.2, seed: int = 42, split: str = "split"
) -> DataFrame:
    """Adds ``split``: exactly ceil(test_size * n) test rows, the same for any data layout."""
    total = df.count()
    count = math.ceil(round(test_size * total, 9))
    return df.withColumn(split, split_column(first_by_hash(df, ids, count, seed, total)))


def random_split_hash(
    df: DataFrame, ids: Sequence[str], test_share: int = 2, of: int = 10, seed: int = 42, split: str = "split"
) -> DataFrame:
    """Adds ``split`` by hash threshold alone: row-local, about test_share/of test rows."""
    return df.withColumn(split, split_column(F.pmod(split_hash(ids, seed), F.lit(of)) < test_share))


def sides(df: DataFrame, split: str = "split") -> tuple[DataFrame, DataFrame]:
    """(train, test) without the split column."""
    return df.where(F.col(split) == "train").drop(split), df.where(F.col(split) == "test").drop(split)


def sort_by_row_id(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Order for output; a range-partitioned sort, not a single task."""
    return df.orderBy(*ids)


def temporal_holdout(df: DataFrame, ts: str, cut: str, split: str = "split", check: bool = True) -> DataFrame:
    """Adds ``split``: train before the cut, test from the cut on. An empty side is an error."""
    moment = F.lit(cut).cast("timestamp_ntz")
    marked = df.where(F.col(ts).isNotNull()).withColumn(split, split_column(F.col(ts) >= moment))
    if check:
        seen = {r[0] for r in marked.select(split).distinct().collect()}
        if seen != {"train", "test"}:
            raise ValueError(f"the hold-out at {cut} leaves a side empty")
    return marked


def fixed_sample(df: DataFrame, n: int, ids: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows chosen by hash, or all when there are fewer."""
    return df.where(first_by_hash(df, ids, n, seed))


def temporal_split_sample(
    df: DataFrame, ts: str, cut: str, n: int, ids: Sequence[str], seed: int = 42, split: str = "split"
) -> DataFrame:
    """Temporal hold-out with a fixed-size sample of each side: 80 % train, the rest test."""
    if n < 10:
        raise ValueError("the sample must have at least 10 rows")
    marked = temporal_holdout(df, ts, cut, split)
    pools = {r[split]: r["count"] for r in marked.groupBy(split).count().collect()}
    train_n = min(int(n * 0.8), pools["train"])
    test_n = min(n - train_n, pools["test"])
    train, test = marked.where(F.col(split) == "train"), marked.where(F.col(split) == "test")
    chosen = ((F.col(split) == "train") & first_by_hash(train, ids, train_n, seed, pools["train"])) | (
        (F.col(split) == "test") & first_by_hash(test, ids, test_n, seed, pools["test"])
    )
    return marked.where(chosen)


def fold_number(ids: Sequence[str], folds: int, seed: int = 42) -> Column:
    """0..folds-1 by hash."""
    return F.pmod(split_hash(ids, seed), F.lit(folds)).cast("int")


def kfold_assign(df: DataFrame, ids: Sequence[str], folds: int = 5, seed: int = 42, fold: str = "fold") -> DataFrame:
    """Adds ``fold``; each row is tested in exactly one fold."""
    return df.withColumn(fold, fold_number(ids, folds, seed))
