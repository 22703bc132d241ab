"""Deterministic row hashes for splits, samples and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_HEX_DIGITS = 15  # 60 bits: positive in a signed long, few ties even at 10^12 rows


def split_key(ids: Sequence[str], seed: int) -> Column:
    """First 15 hex digits of the MD5 of ``seed:id1:id2…``; the same for any data layout.

    As text of one length it sorts like the number it spells.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids])
    return F.substring(F.md5(text), 1, HASH_HEX_DIGITS)


def split_hash(ids: Sequence[str], seed: int) -> Column:
    """The same 60 bits as a number, for remainders."""
    return F.conv(split_key(ids, seed), 16, 10).cast("long")
