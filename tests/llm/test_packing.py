"""Token pieces, packings and matrices: exact round trips and brute force."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerline.llm import genetic, packing, tokens
from ledgerline.llm.common import documents

ODD = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "x" * 9000), (5, " \n\t  é𝒳 " * 900), (6, "word " * 5000), (7, "same"), (7, "same"), (None, "no id")]


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def texts(spark, folder):
    return [(r["doc_id"], r["text"]) for r in documents(spark, folder).select("doc_id", "text").collect()]


def test_ids_equal_the_tokenizers_ids(texts):
    own = tokens.Encoder(open(tokens.default_ranks(), "rb").read())
    tokenizer = reference()
    for _, text in [*texts, *ODD]:
        want = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        assert own.ids(text, 2).tolist() == want


def brute_best_fit(items, limit):
    bins = []
    for item in sorted(items, reverse=True):
        open_bins = [b for b in bins if limit - sum(b) >= item]
        if open_bins:
            max(open_bins, key=sum).append(item)
        else:
            bins.append([item])
    return bins


@pytest.mark.parametrize("seed", range(25))
def test_grouped_best_fit_equals_item_by_item(seed):
    rng = random.Random(seed)
    limit = rng.choice([1, 10, 37, 100])
    items = [rng.randint(1, limit) for _ in range(rng.randint(1, 300))]
    groups = packing.best_fit(Counter(items), limit)
    want = brute_best_fit(items, limit)
    assert sorted(map(sum, want)) == sorted(sum(g.lengths) for g in groups for _ in range(g.count))
    places = defaultdict(list)
    slots = packing.Slots(groups)
    for length, n in Counter(items).items():
        for b, o in zip(*slots.places(np.full(n, length), np.arange(n))):
            places[b].append((o, length))
    assert len(places) == len(want)
    for inside in places.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert at <= limit


def test_capacity_tree_finds_the_smallest():
    rng = random.Random(4)
    tree, present = packing.CapacityTree(50), Counter()
    for _ in range(400):
        free = rng.randint(0, 50)
        if rng.random() < 0.6:
            tree.add(free, packing.Group((1,), 1))
            present[free] += 1
        elif present[free]:
            tree.take(free)
            present[free] -= 1
        length = rng.randint(1, 50)
        assert tree.fitting(length) == min((f for f in present if present[f] and f >= length), default=None)


def content(groups):
    found = Counter()
    for g in groups:
        for length in g.lengths:
            found[length] += g.count
    return found


@pytest.mark.parametrize("seed", range(5))
def test_genetic_packing_keeps_all_pieces_and_improves(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randint(20, 50) for _ in range(500))
    start = [genetic.founder(counts, 100, random.Random(i), i == 0) for i in range(8)]
    end = genetic.evolve(start, 100, random.Random(seed), 12, genetic.least_bins(counts, 100))
    assert all(content(g) == counts and max(map(lambda x: sum(x.lengths), g)) <= 100 for g in [*start, *end])
    assert packing.bins_of(end[0]) < min(map(packing.bins_of, start))
    child = genetic.crossover(start[0], start[1], 100, rng)
    assert content(child) == counts


def test_exchanges_fill_bins_and_lose_nothing():
    rng = random.Random(4)
    assert genetic.exchange((60, 30), 10, [5, 40]) == ((30,), (40,))
    assert genetic.exchange((60,), 40, [15, 25, 39]) == ((), (15, 25))
    assert genetic.exchange((90, 10), 0, [5, 95]) is None
    for _ in range(50):
        lengths = Counter(rng.randint(1, 60) for _ in range(60))
        groups = packing.best_fit(dict(lengths), 100)
        loose = Counter(rng.randint(1, 60) for _ in range(8))
        made, left = genetic.exchanged(groups, loose, 100, rng)
        assert content(made) + left == lengths + loose
        assert packing.bins_of(made) == packing.bins_of(groups) and all(sum(g.lengths) <= 100 for g in made)
        assert sum(n * k for n, k in left.items()) <= sum(n * k for n, k in loose.items())


def test_evolution_beats_its_founders_on_given_lengths(spark, folder):
    """Fuller bins than any founder's, from mutation, crossover and exchanges."""
    counts = packing.histogram(packing.length_counts(packing.stored(tokens.pieces(documents(spark, folder), 1024, 2), "pieces")))
    rng = random.Random(1)
    founders = [genetic.founder(counts, 1024, rng, exact=i == 0) for i in range(genetic.POPULATION)]
    found = genetic.evolve(founders, 1024, rng, 12, 0)
    assert all(content(g) == Counter(counts) for g in found)
    assert genetic.fitness(found[0], 1024) < min(genetic.fitness(g, 1024) for g in founders)


def test_islands(spark):
    rng = random.Random(9)
    counts = dict(Counter(rng.randint(20, 50) for _ in range(400)))
    found = genetic.pack(spark, counts, 100, islands=3, rounds=2, generations=6)
    assert content(found) == counts
    assert packing.bins_of(found) < packing.bins_of(packing.best_fit(counts, 100))
    assert found == genetic.pack(spark, counts, 100, islands=3, rounds=2, generations=6)


def check_places(rows, ids_of, limit):
    """Pieces cover the documents; sequences are gapless and within the limit."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for inside in by_sequence.values():
        at = 0
        for offset, length in sorted(inside):
            assert offset == at
            at += length
        assert 0 < at <= limit
    assert set(by_doc) == set(ids_of)
    for doc, own in by_doc.items():
        copies, ids = ids_of[doc]
        assert len(own) % copies == 0
        for number, group in enumerate(sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own})):
            piece, start, length, crc = group
            assert piece == number
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            assert length == limit or piece == 0
        assert sum(r["length"] for r in own) == copies * len(ids)
    return len(by_sequence)


def test_packing_of_documents(spark, folder, texts):
    tokenizer = reference()
    extra = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("doc_id + 100000 AS doc_id", "text", "'x' AS offset", "1 AS part")
    docs = documents(spark, folder).selectExpr("doc_id", "text", "'x' AS offset", "1 AS part").union(extra)
    ids_of = {}
    for doc, text in [*texts, *[(d and d + 100000, t) for d, t in ODD]]:
        ids_of[doc] = (ids_of.get(doc, (0,))[0] + 1, tokenizer.encode(text or "", add_special_tokens=False).ids + [2])
    bins = check_places(genetic.pack_documents(docs).collect(), ids_of, 1024)
    total = sum(n * len(ids) for n, ids in ids_of.values())
    assert bins <= -(-total // 1024) + 1
    assert genetic.pack_documents(docs.limit(0)).collect() == []


def test_matrix_round_trip(spark, folder, texts):
    tokenizer = reference()
    extra = spark.createDataFrame(ODD[:-1], "doc_id long, text string").selectExpr("doc_id + 100000 AS doc_id", "text")
    matrix = packing.packed_matrix(documents(spark, folder).select("doc_id", "text").union(extra), limit=512).collect()
    found = defaultdict(list)
    for row in matrix:
        ids = np.frombuffer(row["ids"], "<u2")
        assert len(ids) == 512 and (ids[row["n_tokens"]:] == 50256).all()
        assert row["cu_seqlens"][0] == 0 and row["cu_seqlens"][-1] == row["n_tokens"] <= 512
        assert row["reset_at"] == row["cu_seqlens"][:-1]
        for doc, piece, start, a, b in zip(row["doc_ids"], row["pieces"], row["starts"], row["cu_seqlens"], row["cu_seqlens"][1:]):
            found[doc].append((piece, start, ids[a:b].tolist()))
    want = defaultdict(list)
    for doc, text in [*texts, *[(d + 100000, t) for d, t in ODD[:-1]]]:
        want[doc].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [50256])
    assert set(found) == set(want)
    for doc, copies in want.items():
        if len(copies) == 1:
            joined = [i for _, start, ids in sorted(found[doc]) for i in ids]
            assert joined == copies[0]
        else:
            assert sorted(ids for _, _, ids in found[doc]) == sorted(copies)
    assert packing.packed_matrix(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert len({r["sequence_id"] for r in matrix}) == len(matrix)


def test_ids_over_16_bits(spark, tmp_path):
    """A vocabulary or an end id that 16 bits cannot hold is written in 32."""
    lines = open(tokens.default_ranks()).read().splitlines()
    ranks = tmp_path / "wide.tiktoken"
    ranks.write_text("\n".join([*lines, f"{base64.b64encode(b' neverseen wide').decode()} 70000"]))
    assert tokens.id_type(2) == "<u2" and tokens.id_type(65_535) == "<u2" and tokens.id_type(65_536) == "<u4"
    assert tokens.id_type(2, str(ranks)) == "<u4"
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    plain = tokens.Encoder(open(tokens.default_ranks(), "rb").read()).ids("some words", 100_000).tolist()
    for row in packing.packed_matrix(docs, limit=8, end=100_000).collect():
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert ids == [*plain, 100_000, *[100_000] * (7 - len(plain))]


def test_matrix_is_written(spark, folder, tmp_path):
    matrix = packing.packed_matrix(documents(spark, folder).limit(20))
    packing.write_matrix(matrix, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == matrix.count()
