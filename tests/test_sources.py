import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.splits import random_split_exact
from ledgerline.session import scratch_path, shared_folder
from ledgerline.sources import manifest, sinks, tables


def test_pruned_scan_reads_only_its_columns(spark, folder):
    df = tables.scan_pruned(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_tax"])
    assert "ReadSchema: struct<l_orderkey:bigint,l_tax:double>" in df._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="nope"):
        tables.scan_pruned(spark, f"{folder}/lineitem.parquet", ["nope"])


def test_row_ids_are_file_positions(spark, tmp_path):
    spark.range(1000).repartition(5).write.parquet(str(tmp_path / "t"))
    df = tables.scan_with_file_row_id(spark, str(tmp_path / "t"))
    assert df.select("source_file", "source_row_id").distinct().count() == 1000
    per_file = df.groupBy("source_file").agg(F.max("source_row_id").alias("m"), F.count("*").alias("n"))
    assert per_file.where(F.col("m") != F.col("n") - 1).isEmpty()
    spark.range(50).coalesce(1).write.parquet(str(tmp_path / "one"))
    one = tables.scan_with_row_id(spark, str(tmp_path / "one"))
    assert one.columns[0] == "source_row_id" and one.where("source_row_id = id").count() == 50


def test_row_ids_are_unique_over_files_and_split_exactly(spark, tmp_path):
    spark.range(101).repartition(2).write.parquet(str(tmp_path / "two"))
    rows = tables.scan_with_row_id(spark, str(tmp_path / "two"))
    assert sorted(r["source_row_id"] for r in rows.collect()) == list(range(101))
    split = random_split_exact(rows, ["source_row_id"])
    assert split.where("split = 'test'").count() == 21 and split.count() == 101


def test_manifest(spark, folder):
    pinned = manifest.file_manifest(spark, folder)
    rows = {Path(r["path"]).name: r for r in pinned.collect()}
    data = Path(folder, "nation.parquet").read_bytes()
    assert rows["nation.parquet"]["bytes"] == len(data)
    assert rows["nation.parquet"]["sha256"] == hashlib.sha256(data).hexdigest()
    expected = spark.createDataFrame([tuple(r) for r in rows.values()], pinned.schema)
    manifest.verify_files(spark, folder, expected)
    with pytest.raises(ValueError, match="orders.parquet"):
        manifest.verify_files(spark, folder, expected.withColumn(
            "sha256", F.when(F.col("path").endswith("orders.parquet"), "0").otherwise(F.col("sha256"))))
    with pytest.raises(ValueError, match="nation.parquet"):
        manifest.verify_files(spark, folder, expected.where("path NOT LIKE '%nation.parquet'"))


def test_sinks_round_trip(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    for sink in (sinks.sink_parquet, sinks.sink_csv, sinks.sink_json):
        back = sink(orders, scratch_path(spark, "orders"))
        assert back.dtypes == orders.dtypes and back.exceptAll(orders).isEmpty() and back.count() == orders.count()


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_footers_and_pinned_files(spark, tmp_path):
    from ledgerline.sources import manifest

    folder, kept = str(tmp_path / "files"), str(tmp_path / "kept")
    for i in range(4):
        spark.range(10 * i, 10 * i + 5).selectExpr("id", "IF(id % 5 = 0, NULL, id) AS v", "'t' AS s").coalesce(1).write.parquet(f"{folder}/{i}")
    rows = manifest.footer_manifest(spark, folder).orderBy("path").collect()
    assert [r["row_count"] for r in rows] == [5] * 4 and all(r["column_count"] == 3 for r in rows)
    columns = {c["name"]: c for c in rows[1]["columns"]}
    assert (columns["id"]["low"], columns["id"]["high"], columns["v"]["nulls"]) == ("10", "14", 1)
    manifest.pin(spark, folder, kept)
    files = {r["path"].split("/")[-2]: r["path"].removeprefix("file:") for r in rows}
    data = open(files["1"], "rb").read()
    open(files["1"], "wb").write(open(files["0"], "rb").read())
    open(files["2"].replace("part-", "other-"), "wb").write(data)
    spark.read.parquet(f"{folder}/3").write.mode("overwrite").parquet(f"{folder}/4")
    got = {(r["path"].split("/")[-2], r["status"]) for r in manifest.compare_with_pinned(spark, folder, kept).collect()}
    assert got == {("0", "same"), ("1", "changed"), ("2", "same"), ("2", "added"), ("3", "same"), ("4", "added")}
    empty = str(tmp_path / "none")
    (tmp_path / "none").mkdir()
    lost = manifest.compare_with_pinned(spark, empty, kept).collect()
    assert {r["status"] for r in lost if "/files/" in r["path"]} == {"missing"} and len(lost) == 4
