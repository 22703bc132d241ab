"""Repeated byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import repeats
from ledgerline.llm.common import documents


def brute_force(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256), with a set of all strings so far."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - 99):
            string = data[i:i + 100]
            if string in seen:
                gone[i:i + 100] = True
            seen.add(string)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[doc] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def answer(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    want = brute_force([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert answer(repeats.report(docs)) == want
    assert answer(repeats.without_repeats(docs.repartition(7), group=2, chunk=5)) == want
    assert any(w[1] for w in want.values())


def planted(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde é") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    rows = []
    for doc in rng.sample(range(-1000, 1000), 60):
        kind = rng.random()
        if kind < 0.4:
            text = prose(rng.randint(0, 40)) + passage[rng.randint(0, 30):rng.randint(120, 400)] + prose(rng.randint(0, 40))
        elif kind < 0.5:
            text = "z" * rng.randint(90, 500)
        elif kind < 0.6:
            text = (prose(15) + "\0") * rng.randint(1, 6)
        else:
            text = prose(rng.randint(0, 80))
        rows.append((doc, text))
    rows += [(2000, rows[3][1]), (2001, rows[3][1]), (2002, "q" * 99), (2003, "q" * 100), (2004, "q" * 101), (2005, "q" * 102), (2006, None), (2007, "")]
    return rows


@pytest.mark.parametrize("seed, group, chunk", [(1, 10_000, 10_000), (2, 3, 4), (3, 1, 1)])
def test_planted_passages(spark, seed, group, chunk):
    rows = planted(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gram", F.lit(1)).repartition(5)
    assert answer(repeats.without_repeats(docs, group=group, chunk=chunk)) == brute_force(rows)


def test_long_documents_are_cut_without_loss(monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 300)
    rng = random.Random(7)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 50, 100, 299, 300, 301, 1500)]
    covered = {number: set() for number in range(len(texts))}
    for whole, ends, numbers, offsets in repeats._blocks(texts):
        gram, content, first, last = repeats.stretches(whole, ends)
        part = np.searchsorted(ends, first, side="right")
        for p, a, b in zip(part, first, last):
            begin = ends[p - 1] if p else 0
            span = {int(s - begin + offsets[p]) for s in range(a, b + 1)}
            assert not covered[numbers[p]] & span
            covered[numbers[p]] |= span
            assert whole[a:b + 100].tobytes() == texts[numbers[p]][min(span):max(span) + 100]
    assert covered == {n: set(range(max(len(t) - 99, 0))) for n, t in enumerate(texts)}


def test_level_sizes_fall():
    family, rng = repeats.LevelFamily(), random.Random(1)
    seen = set()
    for _ in range(40):
        batch = [rng.randrange(3000) for _ in range(100)]
        first = family.first_seen(np.array([b"%099d." % b for b in batch], "S100"))
        for value, is_first in zip(batch, first):
            assert is_first == (value not in seen)
            seen.add(value)
    sizes = [len(level) for level in family.levels]
    assert sizes == sorted(sizes, reverse=True) and sum(sizes) == len(seen) and len(sizes) < 9


def test_shared_and_missing_ids(spark):
    text = "".join(random.Random(3).choices("abcdefghij", k=150))
    rows = [(5, text), (5, text), (5, text + "!"), (None, text), (None, text), (4, "x" + text), (6, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in repeats.report(docs).collect())
    assert got == [(False, 4, 151, 0), (False, 5, 150, 150), (False, 5, 150, 150), (False, 5, 151, 150),
                   (False, 6, 5, 0), (True, 0, 150, 150), (True, 0, 150, 150)]
    assert repeats.report(docs.limit(0)).collect() == []
    assert repeats.report(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()["n_removed"] == 0
