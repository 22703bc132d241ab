"""Bottom-k sketches against the shingle sets themselves."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import sketches
from ledgerline.llm.common import documents


def shingles(text):
    words = text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
    words = [w for w in words if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def expected(rows):
    """doc_id -> (text, edited, next) by brute force."""
    ordered = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        out[doc] = (text, text[:len(text) - half] + after[:half], after)
    return out


def check(got, rows, tolerance):
    want = expected(rows)
    assert sorted(got) == sorted(want)
    for doc, r in got.items():
        text, edited, after = want[doc]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r["near_edited"] - jaccard(text, edited)) <= tolerance
        assert abs(r["near_next"] - jaccard(text, after)) <= tolerance
        assert abs(r["distinct_shingles"] - len(shingles(text))) <= 0.3 * len(shingles(text))


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: r for r in sketches.fingerprint_edits(docs).collect()}
    check(got, rows, 0.16)


def test_order_of_sparse_ids_and_odd_texts(spark):
    rows = [(-9_000_000, "a b c d e f g"), (3, None), (4, ""), (5000, "  \n"), (4095, "x"), (4096, "x"), (10**15, "é 𝒳 z " * 40),
            (8192, "one two three four five six")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_block", F.lit("clash"))
    got = {r["doc_id"]: r for r in sketches.fingerprint_edits(docs).collect()}
    check(got, rows, 1e-9)
    assert got[4095]["fingerprint"] == got[4096]["fingerprint"] and got[3]["fingerprint"] == ""
    assert got[3]["near_next"] in (0.0, 1.0)


def test_one_document_empty_table_and_missing_ids(spark):
    one = spark.createDataFrame([(7, "a b c d e f")], "doc_id long, text string")
    check({r["doc_id"]: r for r in sketches.fingerprint_edits(one).collect()}, [(7, "a b c d e f")], 1e-9)
    assert sketches.fingerprint_edits(one.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, "a b"), (None, "c d"), (1, "e f"), (1, "e f")], "doc_id long, text string")
    assert len(sketches.fingerprint_edits(odd).collect()) == 4


@pytest.mark.parametrize("parts", [2, 5])
def test_merged_parts_equal_the_whole(spark, parts):
    words = [f"w{i * i % 977}" for i in range(3000)]
    whole = spark.createDataFrame([("d", " ".join(words))], "key string, text string")
    step = len(words) // parts
    pieces = [("d", " ".join(words[i:i + step + 4])) for i in range(0, len(words), step)]
    split = sketches.with_sketch(spark.createDataFrame(pieces, "key string, text string"), "text", "s")
    merged = sketches.merge_sketches(split, ["key"], "s").first()["s"]
    assert merged == sketches.with_sketch(whole, "text", "s").first()["s"]


def test_containment(spark):
    text = " ".join(f"w{i}" for i in range(200))
    df = spark.createDataFrame([(text, text + " " + " ".join(f"v{i}" for i in range(20)))], "a string, b string")
    both = sketches.with_sketch(sketches.with_sketch(df, "a", "x"), "b", "y")
    assert both.select(sketches.containment("x", "y")).first()[0] == pytest.approx(1.0)
    assert both.select(sketches.containment("y", "x")).first()[0] == pytest.approx(196 / 216)
