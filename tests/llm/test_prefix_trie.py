"""The trie of prefixes against one built from whole rebuilt texts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm import ordered, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = turns.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members[tuple(sequence[:d])].append(c)
    nodes = {}
    for node, convs in members.items():
        inside = [n for n in members if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(rebuilt[c]) == len(node)))
        leaves = [n for n in inside if all(len(rebuilt[c]) == len(n) for c in members[n])]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in inside if n)
        children = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        parent = min(members[node[:-1]]) if node else None
        nodes[min(convs), len(node)] = (
            min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()
        )
    return nodes


def same(spark, rows):
    got = prefix_trie.report(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()
    want = plain(rows)
    assert len(got) == len(want)
    assert {(r["conv_id"], r["depth"]): tuple(r) for r in got} == want


def test_given_conversations(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(spark, rows)


def test_shared_turns_nulls_ties_and_absent_bases(spark):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 60), *range(250, 290), -5, -120]:
        for t in range(rng.randrange(9)):
            turn = None if rng.random() < 0.1 else t if rng.random() < 0.8 else 1
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["", "a", "é" * 5, None, "same"])))
    rows += rows[:7] + [(None, 0, "user", "nobody")]
    same(spark, rows)


def test_one_long_conversation_and_many_copies(spark):
    rows = [(0, t, "user", "x" * (t % 3)) for t in range(400)]
    rows += [(c, t, "user", f"copy {t}") for c in range(100, 160) for t in range(8)]
    same(spark, rows)


def test_no_conversations(spark):
    assert prefix_trie.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_other_columns_are_not_read(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "a")]
    plain_nodes = prefix_trie.report(spark.createDataFrame(rows, SCHEMA)).collect()
    names = ["depth", "f0", "idx", "h0", "length"]
    wider = spark.createDataFrame([(*r, *[7] * len(names)) for r in rows], SCHEMA + "".join(f", {n} int" for n in names))
    assert {tuple(r) for r in prefix_trie.report(wider).collect()} == {tuple(r) for r in plain_nodes}


def test_products_modulo_the_prime():
    rng = random.Random(1)
    a = [rng.randrange(prefix_trie.PRIME) for _ in range(2000)] + [0, 1, prefix_trie.PRIME - 1]
    b = [rng.randrange(prefix_trie.PRIME) for _ in range(2000)] + [prefix_trie.PRIME - 1] * 3
    got = prefix_trie.multiply(np.array(a), np.array(b))
    assert got.tolist() == [x * y % prefix_trie.PRIME for x, y in zip(a, b)]


def test_a_collision_is_found_and_other_bases_taken(spark, monkeypatch):
    """Equal fingerprints of different sequences: the first bases make every power one."""
    real = prefix_trie.base_of
    monkeypatch.setattr(prefix_trie, "base_of", lambda lane, attempt: 1 if attempt == 0 else real(lane, attempt))
    same(spark, [(101, 0, "user", "a"), (101, 1, "user", "b"), (160, 0, "user", "b"), (160, 1, "user", "a"),
                 *[(c, t, "user", "ab"[(c + t) % 2]) for c in range(200, 212) for t in range(8)]])


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_sums_of_groups_over_many_partitions(spark, partitions):
    from pyspark.sql import functions as F

    rng = random.Random(9)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(5), i, rng.randrange(10)) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, o int, x long")
    got = ordered.running_sums(df, ["g"], ["o"], {"s": F.col("x")}, partitions=partitions).collect()
    total, want = defaultdict(int), {}
    for g, o, x in rows:
        total[g] += x
        want[o] = total[g]
    assert {r["o"]: r["s"] for r in got} == want
