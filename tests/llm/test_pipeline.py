"""The pipeline's stages against brute force on a small table."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerline.llm import mixing, simhash
from ledgerline.llm.common import documents
from tests.llm.test_line_dedup import brute_force as brute_lines
from tests.llm.test_packing import check_places
from tests.llm.test_quality_rules import brute_force as brute_rules
from tests.llm.test_simhash import fingerprint, groups


CLASHING = ["_key", "_kept", "_all", "_places", "_gone", "_tie", "_bad", "_done", "_words", "_original"]


@pytest.fixture(scope="module")
def results(spark, folder, tmp_path_factory):
    """Rows of each stage, as the driver would run them."""
    docs, found = documents(spark, folder), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs)
    return found


def test_stages(results, spark, folder):
    source = documents(spark, folder)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "best_fit_packing"]
    assert all(r.columns == source.columns and r.dtypes == source.dtypes for r in results[:-1])
    tables = [{r["doc_id"]: r.asDict() for r in t.collect()} for t in [source, *results[:-1]]]

    judged = brute_rules([(d, r["text"], r["source"]) for d, r in tables[0].items()])
    assert tables[1] == {d: r for d, r in tables[0].items() if judged[d][-1]}

    after = brute_lines([(d, r["text"]) for d, r in tables[1].items()])
    assert {d: r["text"] for d, r in tables[2].items()} == {d: text for d, (_, _, text) in after.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in tables[2].values())

    label = groups([(d, fingerprint(r["text"])) for d, r in tables[2].items()])
    assert tables[3] == {d: r for d, r in tables[2].items() if label[d] == d}

    drawn = {r["doc_id"] for r in mixing.mix(mixing.with_tokens_and_topic(results[2])).where("sampled").collect()}
    assert tables[4] == {d: r for d, r in tables[3].items() if d in drawn} and 0 < len(drawn) < len(tables[3])

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids_of = {d: (1, tokenizer.encode(r["text"], add_special_tokens=False).ids + [2]) for d, r in tables[4].items()}
    rows = results[-1].collect()
    bins = check_places(rows, ids_of, 1024)
    assert bins <= -(-sum(len(ids) for _, ids in ids_of.values()) // 1024) + 1


def test_run_equals_the_stages(results, spark, folder):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    key = lambda df: sorted(map(tuple, df.select(*columns).collect()))
    assert key(corpus_pipeline.run(spark, folder)) == key(results[-1])


def test_odd_rows_pass_all_stages(spark, tmp_path):
    long = " ".join(f"word{i * 7 % 1009} of line\n" if i % 9 == 0 else f"word{i * 7 % 1009}" for i in range(4000))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", len(long)), (3, long, "en", "a", len(long)),
            (3, long[5000:], "en", "b", 3), (None, long[::-1], None, None, 9), (4, "few words", "de", "b", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = table.selectExpr("*", "'x' AS tokens", "1 AS kept", *[f"2 AS {c}" for c in CLASHING])
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            before = docs.columns
            docs = stage(spark, docs, "")
            docs.write.parquet(str(tmp_path / f"{table.count()}-{number}"))
            docs = spark.read.parquet(str(tmp_path / f"{table.count()}-{number}"))
            assert number == 4 or docs.columns == before
            assert number == 4 or {(r["tokens"], r["kept"]) for r in docs.collect()} <= {("x", 1)}
            assert number == 4 or all(r[c] == 2 for r in docs.collect() for c in CLASHING)
        assert table.count() or docs.count() == 0
