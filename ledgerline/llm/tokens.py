"""Token ids of whole documents, cut into pieces that fit a sequence.

The vocabulary is a file of byte-level BPE ranks; the driver reads it once and every worker
gets it by broadcast. The ids are those of the vocabulary's JSON form in ``tokenizers``,
where the text of a special token stands for that token.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}
_loaded: dict[int, object] = {}


def default_ranks() -> str:
    """Place of the ranks of the installed byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def id_type(end: int, ranks: str | None = None) -> str:
    """Little-endian type that holds every id of the vocabulary and the end id: 16 bits, or 32."""
    with open(ranks or default_ranks(), "rb") as file:
        top = max(int(line.split()[1]) for line in file if line.strip())
    return "<u2" if max(top, end, *SPECIAL.values()) < 1 << 16 else "<u4"


class Encoder:
    """Encodes with ranks that came as bytes; built once per worker process."""

    def __init__(self, content: bytes, special: dict[str, int] = SPECIAL):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}
        self.special = special
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str | None, end: int) -> np.ndarray:
        """Ids of the whole text (null: none), then the end id."""
        text = text or ""
        allowed = "all" if any(s in text for s in self.special) else set()
        found = self.encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=())
        return np.append(found, end).astype("<u4")


def encoder(content: bytes) -> Encoder:
    key = zlib.crc32(content)
    if key not in _loaded:
        _loaded[key] = Encoder(content)
    return _loaded[key]


def cut(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: all full but the first."""
    first = total % limit or limit
    if total <= limit:
        return [(0, total)]
    return [(0, first), *[(start, limit) for start in range(first, total, limit)]]


def pieces(docs: DataFrame, limit: int, end: int, ranks: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part, number, and the ids if asked for.

    ``part`` is the task's partition and ``number`` counts the pieces of one length inside
    it. Store the rows before using both: that pins them. Ids are numbers of ``id_type``.
    """
    kind = id_type(end, ranks) if with_ids else None
    with open(ranks or default_ranks(), "rb") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(shared.value)
        part = TaskContext.get().partitionId()
        numbers = np.zeros(limit + 1, np.int64)
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = own.ids(text, end)
                for piece, (start, length) in enumerate(cut(len(ids), limit)):
                    mine = ids[start:start + length]
                    row = (doc, piece, start, length, zlib.crc32(mine.tobytes()), part, numbers[length])
                    rows.append(row + (mine.astype(kind).tobytes(),) if with_ids else row)
                    numbers[length] += 1
                if with_ids and len(rows) >= 4096:
                    yield frame(rows)
                    rows = []
            yield frame(rows)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"] + ["ids"] * with_ids

    def frame(rows):
        made = pd.DataFrame(rows, columns=names)
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, number bigint"
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return narrow.mapInPandas(run, schema + (", ids binary" if with_ids else ""))
