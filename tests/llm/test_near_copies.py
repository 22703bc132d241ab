"""Groups of near-copies against all pairs of shingle sets."""

import random

from pyspark.sql import functions as F

from ledgerline.llm import near_copies
from ledgerline.llm.common import documents


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))}


def firsts(pairs):
    """The smallest document of each group, over all pairs, and the number of similar pairs."""
    sets = [(d, shingle_set(t)) for d, t in sorted(pairs, key=lambda p: p[0])]
    label, similar = {d: d for d, _ in sets}, 0

    def top(d):
        while label[d] != d:
            d = label[d]
        return d

    for i, (x, a) in enumerate(sets):
        for y, b in sets[:i]:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * (c := len(a & b)) >= 4 * (len(a) + len(b) - c):
                similar += 1
                low, high = sorted((top(x), top(y)))
                label[high] = low
    return {d for d in label if label[d] == d}, similar


def variants(rng, first, count):
    """Documents of 200 words in families: each member changes up to six words of an earlier one."""
    rows = []
    for family in range(count):
        members = [[f"w{rng.randrange(5000)}" for _ in range(200)]]
        for _ in range(rng.choice([1, 2, 9])):
            words = list(rng.choice(members))
            for place in rng.sample(range(200), rng.randrange(1, 7)):
                words[place] = f"x{rng.randrange(10 ** 6)}"
            members.append(words)
        rows += [" ".join(w) for w in members]
    rng.shuffle(rows)
    return [(first + i, text) for i, text in enumerate(rows)]


def test_given_documents_and_planted_families(spark, folder):
    rows = variants(random.Random(3), 10 ** 6, 60)
    given = documents(spark, folder)
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    docs = given.unionByName(planted, allowMissingColumns=True)
    want, similar = firsts([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert similar > 100  # else the planted rows are not the test they should be
    got = near_copies.one_per_group(docs)
    assert got.columns == docs.columns
    assert sorted(r["doc_id"] for r in got.select("doc_id").collect()) == sorted(want)


def test_one_changed_word_and_unrelated_texts(spark):
    words = [f"word{i}" for i in range(100)]
    changed = [*words[:50], "other", *words[51:]]
    short = [f"word{i}" for i in range(70)]
    rows = [(4, " ".join(changed)), (2, " ".join(words).upper()), (3, " ".join(short)), (9, "few words"), (8, "Few  words"), (7, None), (6, " \n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("token", F.lit("clash"))
    assert sorted(r["doc_id"] for r in near_copies.one_per_group(docs).collect()) == [2, 3, 6, 8]
    assert near_copies.one_per_group(docs.limit(0)).collect() == []
