"""Hashed character n-grams of whole texts, and their counts over a corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
SIZE = 1 << BITS
ORDERS = (1, 2, 3)
BLOCK = 1 << 20  # characters of a text that are hashed at a time
_MIX = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def buckets(text: str, orders: tuple[int, ...] = ORDERS) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, in arrays of bounded size."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    for start in range(0, len(codes), BLOCK):
        for n in orders:
            part = codes[start:start + BLOCK + n - 1]
            if len(part) < n:
                continue
            count = len(part) - n + 1
            mixed = np.full(count, n * 0x165667B1 & 0xFFFFFFFF, np.uint32)
            for i in range(n):
                mixed += part[i:i + count] * np.uint32(_MIX[i])
                mixed ^= mixed >> np.uint32(13)
                mixed *= np.uint32(0x2C1B3C6D)
            yield mixed >> np.uint32(32 - BITS)


def counts(text: str, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each bucket occurs in a text."""
    found = np.zeros(SIZE, np.int64)
    for part in buckets(text, orders):
        if len(part) > 2048:
            found += np.bincount(part, minlength=SIZE)
        else:
            np.add.at(found, part, 1)
    return found


def present(text: str, flags: np.ndarray, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Sets the flags (all false before) of the buckets of a text."""
    for part in buckets(text, orders):
        flags[part] = True
    return flags


def document_frequencies(texts: DataFrame, classes: int = 1, lower: bool = True) -> np.ndarray:
    """Per class and bucket, the number of texts with the bucket, over all rows.

    ``texts`` has (text, class). Each task counts its rows in one table of fixed size; the
    sums come to the driver as one row per bucket.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((classes, SIZE), np.int64)
        flags = np.zeros(SIZE, bool)
        for batch in batches:
            for text, kind in zip(batch["text"], batch["class"]):
                flags[:] = False
                totals[kind] += present(text.lower() if lower else text, flags)
        used = np.flatnonzero(totals.any(axis=0))
        yield pd.DataFrame({"bucket": used.astype("int32"), **{f"c{k}": totals[k, used] for k in range(classes)}})

    columns = [f"c{k}" for k in range(classes)]
    rows = texts.mapInPandas(count, "bucket int, " + ", ".join(f"{c} bigint" for c in columns))
    summed = rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in columns]).collect()
    table = np.zeros((classes, SIZE), np.int64)
    for row in summed:
        table[:, row["bucket"]] = [row[c] for c in columns]
    return table
