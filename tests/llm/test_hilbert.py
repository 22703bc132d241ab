"""Shards along the curve: the curve's own laws, the contract's counts, and what a reader skips."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import hilbert
from ledgerline.llm.common import documents

SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.mark.parametrize("axes, bits", [(2, 1), (2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(axes, bits):
    grid = np.stack([a.ravel() for a in np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij")])
    place = hilbert.curve_index(grid, bits)
    assert sorted(place.tolist()) == list(range(1 << bits * axes))
    walk = grid[:, np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=1)).sum(axis=0) == 1).all()


def checked(rows, texts, count=16):
    """The contract's columns; ``texts`` maps ids to texts."""
    sizes = Counter(r["shard"] for r in rows)
    assert len(rows) == len(texts) and set(sizes) <= set(range(count))
    assert max(sizes.values(), default=0) - min((sizes[s] for s in range(count)), default=0) <= 1
    for shard in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sizes[shard]))
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    in_order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in in_order] == sorted(r["curve"] for r in rows)


def test_given_documents(spark, folder):
    docs = documents(spark, folder)
    checked(hilbert.report(docs).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_against_plain_cells_and_order(spark, folder):
    """Cells and curve again in plain Python, from the boundaries."""
    rows = documents(spark, folder).select(*hilbert.described()).cache()
    cuts = {d: hilbert.boundaries(rows, d, 3) for d in hilbert.DIMENSIONS}
    got = hilbert.shards(documents(spark, folder), count=7, bits=3).collect()
    for d in hilbert.DIMENSIONS:
        assert len(cuts[d]) <= 8
    hashes = {r["doc_id"]: r["text_hash"] for r in rows.collect()}
    want = []
    for r in got:
        cells = [0 if r[d] is None else min(sum(c <= r[d] for c in cuts[d]), 7) for d in hilbert.DIMENSIONS]
        place = int(hilbert.curve_index(np.array(cells)[:, None], 3)[0])
        assert r["curve"] == place
        want.append((place, hashes[r["doc_id"]], r["doc_id"]))
    want.sort()
    n = len(want)
    assert {r["doc_id"]: r["shard"] for r in got} == {d: i * 7 // n for i, (_, _, d) in enumerate(want)}


def test_cells_hold_about_equal_numbers(spark):
    rows = spark.range(4000).select(F.col("id").alias("x"), F.format_string("v%04d", F.col("id") % 500).alias("s"))
    for column in ("x", "s"):
        cuts = hilbert.boundaries(rows, column, 4)
        values = [r[column] for r in rows.collect()]
        cells = Counter(sum(c <= v for c in cuts) for v in values)
        assert max(cells.values()) <= 1.3 * 4000 / 16


def test_nulls_copies_long_texts_and_hot_values(spark):
    rows = [(i, "same text", "en", "hot") for i in range(70)]  # one text and source of a third and more
    rows += [(100 + i, f"text {i}", [None, "de", ""][i % 3], f"s{i % 9}") for i in range(60)]
    rows += [(300, None, "en", None), (301, "", None, None), (302, "é" * 200_000, "fr", "long"), (-4, "x", "en", "hot")]
    texts = {r[0]: r[1] for r in rows}
    checked(hilbert.report(spark.createDataFrame(rows, SCHEMA)).collect(), texts)


def test_repeated_rows_and_null_ids_take_a_place_each(spark):
    rows = [(1, "a", "en", "s")] * 20 + [(None, "b", "en", "s")] * 13
    got = hilbert.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(Counter(r["shard"] for r in got).values()) == [2] * 15 + [3]


def test_few_and_no_documents(spark):
    assert hilbert.report(spark.createDataFrame([], SCHEMA)).collect() == []
    checked(hilbert.report(spark.createDataFrame([(5, "a", "en", "s")], SCHEMA)).collect(), {5: "a"})


def test_clashing_columns_are_not_read(spark):
    wide = SCHEMA + ", size int, curve int, shard int, slot int, place int, run int, text_hash int"
    df = spark.createDataFrame([(i, f"t{i}", "en", "s", *[9] * 7) for i in range(40)], wide)
    checked(hilbert.report(df).collect(), {i: f"t{i}" for i in range(40)})


def test_written_shards_round_trip_and_skip(spark, tmp_path):
    """All rows come back whole, and a filter on any of three independent columns skips shards."""
    rows = [(i, "t" * (1 + i // 80), ["en", "de", "fr", "es"][i // 20 % 4], f"s{i % 20:02d}") for i in range(4000)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("curve", F.lit(1)).repartition(7)
    ranges = hilbert.write_shards(docs, str(tmp_path / "out"), count=64, dimensions=("source", "lang", "size")).collect()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.drop("shard").exceptAll(docs).isEmpty() and back.count() == 4000
    sizes = Counter(r["shard"] for r in back.select("shard").collect())
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 64
    for column, value in (("source", "s07"), ("lang", "de"), ("size", 40)):
        read = sum(r[f"least_{column}"] <= value <= r[f"most_{column}"] for r in ranges)
        assert read <= 32, (column, read)  # in an order by one column, filters on the others read all 64
