import pytest
from pyspark.sql import functions as F

from ledgerline.operators import filters as flt
from ledgerline.operators import quality as q


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_required_and_resolved_columns(spark, caplog):
    df = spark.createDataFrame([(1, 2)], "A int, b int")
    with pytest.raises(ValueError, match=r"\['x', 'y'\]"):
        q.require_columns(df, ["y", "A", "x"])
    assert q.resolve_columns(df, ["a", "B", "c"]) == ["A", "b"]
    assert "c" in caplog.text
    with pytest.raises(ValueError):
        q.resolve_columns(df, ["nope"])
    assert q.existing_columns(df, ["b", "c"]) == ["b"]


def test_duplicates_treat_null_and_nan_as_equal(spark):
    df = spark.createDataFrame(
        [(1, None, float("nan")), (2, None, float("nan")), (3, "x", 1.0), (4, "x", 1.0), (5, "x", 1.0), (6, "y", 1.0)],
        "id int, a string, b double",
    )
    assert tuple(q.duplicate_count(df, ["a", "b"]).first()) == (6, 3)
    assert tuple(q.duplicate_count(df.limit(0), ["a"]).first()) == (0, 0)
    assert [r["id"] for r in q.dedup_keep_first(df, "id").orderBy("id").collect()] == [1, 3, 6]
    subset = q.dedup_keep_first(df.withColumn("c", F.col("id") * 10), "id", ["a"])
    assert subset.columns == ["id", "a", "b", "c"]
    assert [(r["id"], r["c"]) for r in subset.orderBy("id").collect()] == [(1, 10), (3, 30), (6, 60)]


@pytest.mark.parametrize("large", [0, 1 << 60])
def test_hash_first_gives_the_same_rows(spark, large):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}" if i % 3 == 1 else f"u{i}", None if i % 2 else 0.0) for i in range(900)]
    rows += [(1000, "u2", -0.0), (1001, None, None), (1002, None, None)]
    df = spark.createDataFrame(rows, "id int, a string, b double")
    seen, first = set(), []
    for i, a, b in rows:
        if (a, b) not in seen:
            seen.add((a, b))
            first.append(i)
    assert sorted(r["id"] for r in q.dedup_keep_first(df, "id", large=large).collect()) == first
    assert tuple(q.duplicate_count(df, ["a", "b"], large).first()) == (len(rows), len(rows) - len(first))
    by_a = q.dedup_keep_first(df, "id", ["a"], large)
    assert by_a.columns == df.columns and by_a.count() == df.select("a").distinct().count()


def test_hot_copies_are_combined_before_the_shuffle(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("same").alias("a"))
    plan = q.dedup_keep_first(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.index("partial_min") > plan.index("Exchange")


def test_audit_steps_join_up(spark):
    df = spark.createDataFrame([(i, float(i % 10) if i % 4 else None) for i in range(100)], "i int, v double")
    rules = [
        q.Rule("known", "v is known", F.col("v").isNotNull()),
        q.Rule("low", "v <= 7", F.col("v") <= 7),
        q.Rule("late", "i >= 10", F.col("i") >= 10),
    ]
    audit = q.filter_audit(df, rules, duplicates=5).orderBy("step_order").collect()
    assert audit[0]["before_rows"] == 105 and audit[0]["removed_rows"] == 5
    for a, b in zip(audit, audit[1:]):
        assert a["after_rows"] == b["before_rows"] == a["before_rows"] - a["removed_rows"]
    left, step = df, 1
    for rule in rules:
        left = left.where(rule.keep)
        assert audit[step]["after_rows"] == left.count()
        step += 1
    assert q.apply_rules(df, rules).count() == audit[-1]["after_rows"]
    empty = q.filter_audit(df.limit(0), rules).collect()
    assert [tuple(r)[3:] for r in empty] == [(0, 0, 0)] * 3


def test_audit_is_one_pass(spark, folder):
    df = spark.read.parquet(f"{folder}/events.parquet")
    plan = q.filter_audit(df, [q.Rule("a", "a", F.col("value") > 1)])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<value:double>" in plan


def test_reconciliation(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "i int, s string")
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "i int, s string")
    assert not all(r["same"] for r in q.reconcile_tables(a, b).collect())
    with pytest.raises(ValueError, match="s"):
        q.require_reconciled(a, b)
    q.require_reconciled(a, a)
    assert rows_of(q.row_differences(a, b).fillna("-")) == [(1, "x", 1), (2, "-", -1)]
    assert q.row_differences(a, a).isEmpty()
    renamed = {r["column"]: r["same"] for r in q.reconcile_tables(a, b.withColumnRenamed("s", "t")).collect()}
    assert renamed == {"i": True, "s": False, "t": False}


def test_guards(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    with pytest.raises(ValueError):
        q.assert_no_nulls(df)
    assert q.assert_no_nulls(df.fillna(0)) is not None
    with pytest.raises(ValueError, match="leak"):
        q.leakage_guard(["a", "b"], ["b"])
    with pytest.raises(ValueError, match="order"):
        q.leakage_guard(["a", "b"], [], ["b", "a"])
    with pytest.raises(ValueError):
        q.expected_rows(df, 2)
    q.expected_rows(df, 1)


def test_filters(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, -1.0), (4, float("nan"))], "i int, v double")
    assert [r["i"] for r in flt.positive_target(df, "v").collect()] == [1]
    assert [r["i"] for r in flt.range_filters(df, {"v": (-1, 1)}).collect()] == [1, 3]
    with pytest.raises(ValueError):
        flt.period_filter(df.withColumn("t", F.lit("2020-01-01").cast("timestamp_ntz")), "t", "2021-01-01", "2022-01-01", True)
    split = df.withColumn("split", F.when(F.col("i") < 3, "train").otherwise("test"))
    assert [r["i"] for r in flt.train_only_filter(split, "split", F.col("v") > 0).collect()] == [1, 3, 4]


def test_period_filter_reaches_the_scan(spark, folder):
    df = flt.period_filter(spark.read.parquet(f"{folder}/events.parquet"), "ts", "2024-01-10", "2024-01-20")
    plan = df.select("value")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "struct<ts:timestamp_ntz,value:double>" in plan


def test_quantile_cap_uses_the_filtered_rows(spark):
    df = spark.range(1, 1001).select(F.col("id").cast("double").alias("v"))
    assert flt.quantile_cap_filter(df.where("v <= 200"), "v", 0.995).count() == 199
    assert flt.trim_quantile_band(df, "v").count() == 980
