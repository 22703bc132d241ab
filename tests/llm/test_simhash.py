"""SimHash groups against all pairs."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import simhash
from ledgerline.llm.common import documents


def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(pairs):
    """doc -> smallest id reachable, over all pairs of fingerprints."""
    label = {d: d for d, _ in pairs}
    changed = True
    while changed:
        changed = False
        for a, fa in pairs:
            low = min(label[b] for b, fb in pairs if (fa ^ fb).bit_count() <= 2)
            if low < label[a]:
                label[a], changed = low, True
    return label


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    pairs = [(r["doc_id"], fingerprint(r["text"])) for r in docs.collect()]
    want = groups(pairs)
    got = {r["doc_id"]: r for r in simhash.report(docs).collect()}
    assert {d: r["fingerprint"] for d, r in got.items()} == {d: f"{f:016x}" for d, f in pairs}
    assert {d: r["component_id"] for d, r in got.items()} == want


def signed(value):
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("hot", [1, 4, 64])
def test_links_of_clustered_values(spark, hot):
    """Every link is found, whichever keys count as hot."""
    rng = random.Random(5)
    values = set()
    for _ in range(40):
        value = rng.getrandbits(64)
        for _ in range(12):
            values.add(value)
            value ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                value ^= 1 << rng.randrange(64)
    values = sorted(values)
    fps = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    links = simhash.ring_links(fps, hot_key=hot)
    assert all((a ^ b).bit_count() <= 2 for a, b in ((r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in links.collect()))
    found = {r["node"]: r["component"] for r in simhash.components(links).collect()}
    want = groups([(signed(v), v) for v in values])
    assert {signed(v): found.get(signed(v), signed(v)) for v in values} == want


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (9, " \t"), (None, ""), (2, "One two three four"), (1, "one two THREE four"), (8, "É é"), (8, "É é")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = [tuple(r) for r in simhash.report(docs).collect()]
    assert len(got) == 8
    by_id = dict((d, (f, c)) for d, f, c in got if d is not None)
    assert by_id[4][1] == by_id[5][1] == by_id[9][1] == 4 and by_id[4][0] == "0" * 16
    assert by_id[1][1] == by_id[2][1] == 1 and by_id[8][1] == 8
    assert simhash.report(docs.limit(0)).collect() == []


def test_one_per_group(spark):
    """Copies of a text and of an id go, whichever row they are in; other columns stay."""
    words = [f"w{i}" for i in range(400)]
    near = [*words[:200], "other", *words[201:]]
    texts = {7: " ".join(words), 3: " ".join(near), 5: " ".join(words).upper(), 9: "something else", 8: None, 6: " ", 4: "Something  else"}
    rows = [(d, t, "clash") for d, t in texts.items()]
    schema = "doc_id long, text string, component_id string"
    label = groups([(d, fingerprint(t)) for d, t in texts.items()])
    docs = spark.createDataFrame(rows, schema)
    want = sorted((d, texts[d], "clash") for d in texts if label[d] == d)
    assert sorted(map(tuple, simhash.one_per_group(docs).collect())) == want and {d for d, _, _ in want} >= {4, 6}
    shared = spark.createDataFrame([*rows, *rows, (None, "w0 w1", "clash"), (None, "w0 w1", "clash"), (9, texts[7], "clash")], schema)
    got = simhash.one_per_group(shared).collect()
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == [d for d, _, _ in want]
    assert [r["text"] for r in got if r["doc_id"] is None] == ["w0 w1"]
    assert simhash.one_per_group(docs.limit(0)).collect() == []


def test_long_text_in_batches(monkeypatch):
    text = " ".join(f"w{i % 3001}" for i in range(9000))
    whole = simhash.text_fingerprint(text)
    monkeypatch.setattr(simhash, "BATCH_HASHES", 1000)
    assert simhash.text_fingerprint(text) == whole
    assert whole % (1 << 64) == fingerprint(text)
