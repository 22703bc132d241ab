"""Similar lines against all pairs of lines."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import line_dedup
from ledgerline.llm.common import documents

GAP = re.compile("[ \t-\r]+")


def tokens(line):
    words = [w for w in GAP.split(line) if w]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_force(rows):
    """doc_id -> (n_lines, removed places, remaining text)."""
    seen, by_token, out = [], {}, {}
    for doc, text in sorted(rows):
        removed, lines = [], (text or "").split("\n")
        worded = 0
        for place, line in enumerate(lines):
            own = tokens(line)
            if not own:
                continue
            worded += 1
            near = {i for t in own for i in by_token.get(t, ())}
            if any(5 * len(own & seen[i]) >= 4 * len(own | seen[i]) for i in near):
                removed.append(place)
            if own not in [seen[i] for i in near]:
                for t in own:
                    by_token.setdefault(t, []).append(len(seen))
                seen.append(own)
        out[doc] = (worded, removed, "\n".join(s for i, s in enumerate(lines) if i not in removed))
    return out


def check(docs, rows):
    want = brute_force(rows)
    got = {r["doc_id"]: (r["n_lines"], r["removed_lines"]) for r in line_dedup.report(docs).collect()}
    assert got == {d: (n, gone) for d, (n, gone, _) in want.items()}
    assert all(r["n_removed"] == len(r["removed_lines"]) for r in line_dedup.report(docs).collect())
    texts = {r["doc_id"]: r["text"] for r in line_dedup.without_similar_lines(docs).collect()}
    assert texts == {d: None if dict(rows)[d] is None else text for d, (_, _, text) in want.items()}


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    check(docs, [(r["doc_id"], r["text"]) for r in docs.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_variants(spark, seed):
    """Lines that differ by a word or some more from one another, many of them."""
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.randint(3, 60))] for _ in range(6)]
    rows = []
    for doc in rng.sample(range(-500, 500), 70):
        lines = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = f"v{rng.randrange(50)}"
            if rng.random() < 0.2:
                line = line[: len(line) // 2 + 1]
            lines.append((" " if rng.random() < 0.8 else "  \t").join(line))
            if rng.random() < 0.2:
                lines.append(rng.choice(["", "  ", "\r"]))
        rows.append((doc, "\n".join(lines)))
    rows += [(1000, None), (1001, ""), (1002, "\n\n"), (1003, "one two"), (1004, "one  two\none two"), (1005, "two one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS line", "'a' AS tokens")
    check(docs, rows)


def test_shared_and_missing_ids(spark):
    line = " ".join(f"w{i}" for i in range(20))
    rows = [(5, line), (5, line), (None, line + "\nlast"), (4, line + " more"), (6, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text"))
    out = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["n_chars"]) for r in line_dedup.without_similar_lines(docs).collect()))
    assert out == [(False, 4, line + " more", len(line) + 5), (False, 5, "", 0), (False, 5, "", 0), (False, 6, "alone", 5), (True, 0, "last", 4)]
    assert line_dedup.without_similar_lines(docs.limit(0)).collect() == [] and line_dedup.report(docs.limit(0)).collect() == []


def test_very_long_text(spark):
    lines = [" ".join(f"w{i}x{j}" for j in range(6)) for i in range(15_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(reversed(lines)) + "\nnew line here")], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in line_dedup.without_similar_lines(docs).collect()}
    assert got == {1: "\n".join(lines), 2: "new line here"}


def test_places_of_any_size_travel_in_two_numbers(spark):
    top = (1 << 31) - 1
    rows = [(7, -3, 0, 1, 1), (-7, 1 << 40, 5, 40, 9), (1, 2, top, top, top), (3, 4, 1 << 20, 1 << 22, 1 << 21)]
    df = spark.createDataFrame(rows, "token long, _key long, line int, n int, place int")
    packed = line_dedup._packed(df)
    assert packed.columns == ["token", "_key", "spot", "more"] and [r["more"] for r in packed.collect()][:2] == [0, 0]
    assert sorted(map(tuple, line_dedup._unpacked(packed).collect())) == sorted(rows)


def test_indexed_tokens_are_shuffled_in_four_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f\ng h")], "_key long, text string")
    lines = line_dedup._lines(docs)
    rows = line_dedup._prefix_rows(lines, line_dedup._class_ranks(lines))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    kept = plan[:plan.index("RepartitionByExpression")], plan[plan.index("RepartitionByExpression"):]
    assert "CAST" in kept[0].upper() and "spot" in kept[1] and "more" in kept[1]
    assert {r["n"] for r in rows.collect()} == {1, 2}


def test_differing_bits_are_no_more_than_differing_tokens(spark):
    rng = random.Random(5)
    whole = [rng.getrandbits(64) - (1 << 63) for _ in range(300)]
    sets = [rng.sample(whole, size) for size in (1, 2, 20, 21, 60, 150, 299, 300)] + [whole[:50], whole[1:51]]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sets)], "i int, t array<bigint>")
    rows = df.select("i", *[line_dedup._bits("t", j).alias(f"b{j}") for j in range(line_dedup.BIT_WORDS)]).collect()
    bits = {r["i"]: [b & (1 << 64) - 1 for b in r[1:]] for r in rows}
    for x in bits:
        for y in bits:
            assert sum((a ^ b).bit_count() for a, b in zip(bits[x], bits[y])) <= len(set(sets[x]) ^ set(sets[y]))
    assert all(b for b in bits[7])  # tokens fall to every number


def test_pairs_far_apart_end_before_their_tokens_are_joined(spark, monkeypatch):
    shared = " ".join(f"s{i}" for i in range(12))
    texts = [f"{shared} " + " ".join(f"w{doc}x{i}" for i in range(30)) for doc in range(8)]
    texts.append(texts[3] + " more")
    base = spark.createDataFrame(list(enumerate(texts)), "_key long, text string")
    pairs = [(x, 0, y, 0) for y in range(9) for x in range(y)]
    written, keep = {}, line_dedup.stored

    def stored(df, name):
        out = keep(df, name)
        written[name] = out.count()
        return out

    monkeypatch.setattr(line_dedup, "stored", stored)
    found = line_dedup._verified(spark.createDataFrame(pairs, "x_key long, x_line int, y_key long, y_line int"), base)
    assert [tuple(r) for r in found.collect()] == [(3, 0, 8, 0)]
    assert written["line-pairs"] == 36 and written["likely-pairs"] == 1
