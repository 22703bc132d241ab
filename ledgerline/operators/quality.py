"""Schema checks, profiles, duplicates and audited quality rules."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.expressions import any_of, row_sum
from ledgerline.functions.sizing import fits_broadcast, measured, scanned_bytes

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Rule:
    """A named keep-condition; unknown (null) counts as failed."""

    step: str
    rule: str
    keep: Column


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise with the sorted missing names."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def resolve_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Actual names of the wanted columns, ignoring case; absent ones are skipped."""
    actual = {c.lower(): c for c in df.columns}
    found = []
    for name in wanted:
        if name.lower() in actual:
            found.append(actual[name.lower()])
        else:
            log.warning("column %s is not in the table and is skipped", name)
    if not found:
        raise ValueError("none of the wanted columns is in the table")
    return found


def existing_columns(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    return [c for c in wanted if c in df.columns]


def _unpivot_row(row: DataFrame, fields: Mapping[str, Mapping[str, str]], name: str = "column") -> DataFrame:
    """One-row aggregate to one row per key; ``fields`` maps output column -> {key: source}."""
    keys = list(next(iter(fields.values())))
    entries = [
        F.struct(F.lit(key).alias(name), *[F.col(src[key]).alias(out) for out, src in fields.items()])
        for key in keys
    ]
    return row.select(F.inline(F.array(*entries)))


def profile_table(df: DataFrame) -> DataFrame:
    """column, position, dtype, null_count, row_count in one pass."""
    columns = df.columns
    aggregates = [F.count("*").alias("_rows")]
    for i, c in enumerate(columns):
        aggregates.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"_n{i}"))
    row = df.agg(*aggregates)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(i).alias("position"),
            F.lit(dtype).alias("dtype"),
            F.col(f"_n{i}").alias("null_count"),
            F.col("_rows").alias("row_count"),
        )
        for i, (c, dtype) in enumerate(df.dtypes)
    ]
    return row.select(F.inline(F.array(*entries)))


def reconcile_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column-by-column comparison of two reads; ``same`` covers name, order, type, nulls, rows."""
    a, b = profile_table(left).alias("a"), profile_table(right).alias("b")
    fields = ("position", "dtype", "null_count", "row_count")
    same = F.lit(True)
    for f in fields:
        same = same & F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
    return a.join(b, F.col("a.column") == F.col("b.column"), "full").select(
        F.coalesce("a.column", "b.column").alias("column"),
        F.col("a.null_count").alias("left_nulls"),
        F.col("b.null_count").alias("right_nulls"),
        F.col("a.row_count").alias("left_rows"),
        F.col("b.row_count").alias("right_rows"),
        same.alias("same"),
    )


def require_reconciled(left: DataFrame, right: DataFrame) -> None:
    """Raise when two reads disagree."""
    different = [r["column"] for r in reconcile_tables(left, right).where(~F.col("same")).collect()]
    if different:
        raise ValueError(f"the two tables differ in: {sorted(different)}")


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows (as multisets) whose number of copies differs, with the surplus on the left."""
    tagged = left.withColumn("_side", F.lit(1)).unionByName(right.withColumn("_side", F.lit(-1)))
    return (
        tagged.groupBy(*left.columns).agg(F.sum("_side").alias("surplus")).where(F.col("surplus") != 0)
    )



def key_edges(df: DataFrame, key: str, ranges: int = 256) -> list:
    """Ends of key ranges with about equal numbers of rows, from a mergeable sketch of a numeric key."""
    shares = [i / ranges for i in range(1, ranges)]
    found = df.agg(F.percentile_approx(key, shares, 10_000)).first()[0]
    return sorted(set(found or []))


def range_digests(df: DataFrame, key: str, edges: Sequence) -> DataFrame:
    """range, row_count and two order-free sums of row hashes per key range; null keys are range -1.

    A multiset of rows has one digest, whatever the order and the files. The columns must have
    the same names, order and types on both sides.
    """
    columns = [F.col(c) for c in df.columns]
    place = F.when(F.col(key).isNull(), -1).otherwise(F.array_size(F.filter(F.array(*[F.lit(e) for e in edges]), lambda e: e < F.col(key))) if edges else F.lit(0))
    sums = [F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).alias(f"digest_{seed}") for seed in (1, 2)]
    return df.groupBy(place.alias("range")).agg(F.count("*").alias("row_count"), *sums)


def differing_ranges(left: DataFrame, right: DataFrame, key: str, edges: Sequence) -> list[int]:
    """Key ranges whose digests differ: a row per range comes to the driver."""
    a, b = range_digests(left, key, edges), range_digests(right, key, edges)
    same = (F.col("a.row_count").eqNullSafe(F.col("b.row_count")) & F.col("a.digest_1").eqNullSafe(F.col("b.digest_1"))
            & F.col("a.digest_2").eqNullSafe(F.col("b.digest_2")))
    joined = a.alias("a").join(b.alias("b"), F.col("a.range") == F.col("b.range"), "full").where(~same)
    return sorted(r["range"] for r in joined.select(F.coalesce("a.range", "b.range").alias("range")).collect())


def in_ranges(key: str, edges: Sequence, places: Sequence[int]) -> Column:
    """Condition on the key alone, neighbours joined, that a scan can use to skip files and row groups."""
    runs: list[list[int]] = []
    for place in sorted(places):
        if runs and place == runs[-1][1] + 1 and place > 0:
            runs[-1][1] = place
        else:
            runs.append([place, place])
    condition = F.lit(False)
    for first, last in runs:
        if first < 0:
            condition = condition | F.col(key).isNull()
            continue
        inside = F.col(key).isNotNull()
        if first > 0:
            inside = inside & (F.col(key) > F.lit(edges[first - 1]))
        if last < len(edges):
            inside = inside & (F.col(key) <= F.lit(edges[last]))
        condition = condition | inside
    return condition


def reconcile_ranges(left: DataFrame, right: DataFrame, key: str, ranges: int = 256) -> DataFrame:
    """``row_differences`` that reads again, and shuffles, only the key ranges whose digests differ."""
    edges = key_edges(left, key, ranges)
    wanted = in_ranges(key, edges, differing_ranges(left, right, key, edges))
    return row_differences(left.where(wanted), right.where(wanted))

def missing_rate(df: DataFrame, columns: Sequence[str] | None = None, keep_zero: bool = False) -> DataFrame:
    """column, missing_rate (percent), highest first; complete columns are left out."""
    columns = list(columns or df.columns)
    row = df.agg(*[
        (F.avg(F.col(c).isNull().cast("int")) * 100.0).alias(f"_m{i}") for i, c in enumerate(columns)
    ])
    table = _unpivot_row(row, {"missing_rate": {c: f"_m{i}" for i, c in enumerate(columns)}})
    if not keep_zero:
        table = table.where(F.col("missing_rate") > 0)
    return table.orderBy(F.desc("missing_rate"), "column")


def _null_count(columns: Sequence[str]) -> Column:
    return row_sum([F.col(c).isNull().cast("int") for c in columns]).cast("int")


def missing_pattern(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows by the number of simultaneously null columns."""
    return (
        df.groupBy(_null_count(columns).alias("missing_column_count"))
        .agg(F.count("*").alias("row_count"))
        .orderBy("missing_column_count")
    )


def missing_any_all(df: DataFrame, columns: Sequence[str], flag: Column | None = None) -> DataFrame:
    """Rows with any and with all columns null, beside the rows where ``flag`` holds."""
    nulls = _null_count(columns)
    aggregates = [
        F.count("*").alias("row_count"),
        F.count_if(nulls > 0).alias("any_missing"),
        F.count_if(nulls == len(list(columns))).alias("all_missing"),
    ]
    if flag is not None:
        aggregates.append(F.count_if(flag).alias("flag_rows"))
        aggregates.append(F.count_if((nulls > 0) & flag).alias("any_missing_and_flag"))
    return df.agg(*aggregates)


def missing_by_group(df: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """Percent null per column for each label, largest label first."""
    return (
        df.groupBy(group)
        .agg(
            F.count("*").alias("row_count"),
            *[(F.avg(F.col(c).isNull().cast("int")) * 100.0).alias(f"{c}_missing") for c in columns],
        )
        .orderBy(F.desc("row_count"), group)
    )


LARGE_INPUT_BYTES = 4 << 30


def _split_by_copies(df: DataFrame, keys: Sequence[str], large: int) -> tuple[DataFrame | None, DataFrame]:
    """(rows that surely have no copy, the rest), or (None, df) where that does not pay.

    On a large input only a hash of the keys is shuffled first. Rows with a hash of their own
    have no copy and are never shuffled. The hashes that repeat must fit a broadcast, which
    is checked; else all rows take the plain way.
    """
    if scanned_bytes(df) < large:
        return None, df
    marked = df.withColumn("_hash", F.xxhash64(*[F.col(c) for c in keys]))
    repeated = measured(
        marked.groupBy("_hash").agg(F.count("*").alias("_n")).where(F.col("_n") > 1).select("_hash")
    )
    if not fits_broadcast(repeated):
        repeated.unpersist()
        return None, df
    single = marked.join(F.broadcast(repeated), "_hash", "left_anti").drop("_hash")
    return single, marked.join(F.broadcast(repeated), "_hash", "left_semi").drop("_hash")


def duplicate_count(
    df: DataFrame, columns: Sequence[str] | None = None, large: int = LARGE_INPUT_BYTES
) -> DataFrame:
    """Rows that repeat an earlier row. Copies are combined before the shuffle."""
    keys = list(columns or df.columns)
    narrow = df.select(*keys)
    single, maybe = _split_by_copies(narrow, keys, large)
    groups = maybe.groupBy(*keys).agg(F.count("*").alias("_copies")).select("_copies")
    if single is not None:
        groups = groups.unionByName(single.select(F.lit(1).cast("long").alias("_copies")))
    return groups.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def dedup_keep_first(
    df: DataFrame, order_by: str | Sequence[str], columns: Sequence[str] | None = None,
    large: int = LARGE_INPUT_BYTES,
) -> DataFrame:
    """Keep the copy with the smallest id; null equals null.

    An aggregate, not a row_number window: the copies of a hot row are combined on
    the map side, so they never meet in one task. ``columns`` default to all but the id.
    """
    ids = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = list(columns) if columns else [c for c in df.columns if c not in ids]
    single, maybe = _split_by_copies(df, keys, large)
    kept = _first_copies(maybe, ids, keys)
    return kept if single is None else kept.unionByName(single)


def _first_copies(df: DataFrame, ids: list[str], keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in ids]
    if len(ids) == 1 and not rest:
        first = df.groupBy(*keys).agg(F.min(ids[0]).alias(ids[0]))
        return first.select(*df.columns)
    kept = F.min(F.struct(*ids)) if not rest else F.min_by(F.struct(*ids, *rest), F.struct(*ids))
    return df.groupBy(*keys).agg(kept.alias("_first")).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns]
    )


def _first_failed(rules: Sequence[Rule]) -> Column:
    """Position of the first rule a row fails, or the number of rules when it passes all."""
    chain = F.when(~F.coalesce(rules[0].keep, F.lit(False)), F.lit(0))
    for i, rule in enumerate(rules[1:], start=1):
        chain = chain.when(~F.coalesce(rule.keep, F.lit(False)), F.lit(i))
    return chain.otherwise(F.lit(len(rules)))


def filter_audit(df: DataFrame, rules: Sequence[Rule], duplicates: int | None = None) -> DataFrame:
    """step_order, step, rule, before_rows, removed_rows, after_rows of an ordered rule chain.

    One pass over the data: each row is counted at the first rule it fails. The running
    totals are taken over the few result rows. ``duplicates`` adds a first step for copies
    removed beforehand.
    """
    names = [("Duplicate removal", "identical rows")] if duplicates is not None else []
    names += [(r.step, r.rule) for r in rules]
    offset = 1 if duplicates is not None else 0
    counted = df.groupBy((_first_failed(rules) + offset).alias("_at")).agg(F.count("*").alias("_rows"))
    totals = counted.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_total"),
        *[
            F.coalesce(F.sum(F.when(F.col("_at") == i, F.col("_rows"))), F.lit(0)).alias(f"_r{i}")
            for i in range(offset, len(names))
        ],
    )
    if duplicates is not None:
        totals = totals.withColumn("_r0", F.lit(duplicates).cast("long")).withColumn(
            "_total", F.col("_total") + F.lit(duplicates)
        )
    entries = []
    before: Column = F.col("_total")
    for i, (step, rule) in enumerate(names):
        removed = F.col(f"_r{i}")
        entries.append(
            F.struct(
                F.lit(i + 1).alias("step_order"),
                F.lit(step).alias("step"),
                F.lit(rule).alias("rule"),
                before.alias("before_rows"),
                removed.alias("removed_rows"),
                (before - removed).alias("after_rows"),
            )
        )
        before = before - removed
    return totals.select(F.inline(F.array(*entries)))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule."""
    for rule in rules:
        df = df.where(rule.keep)
    return df


def clean_summary(
    df: DataFrame,
    rules: Sequence[Rule],
    checked: str,
    valid_range: tuple[float, float],
    label: Column,
) -> DataFrame:
    """Counts before and after the rules, what was missing or reclassified, and the label rate."""
    valid = _first_failed(rules) == len(rules)
    value = F.col(checked)
    missing = value.isNull()
    out_of_range = value.isNotNull() & ~value.between(*valid_range)
    positive = F.coalesce(label.cast("boolean"), F.lit(False))
    row = df.agg(
        F.count("*").alias("raw_rows"),
        F.count_if(valid).alias("valid_rows"),
        F.count_if(valid & missing).alias("original_missing_rows"),
        F.count_if(valid & out_of_range).alias("reclassified_rows"),
        F.count_if(valid & positive).alias("positive_label_rows"),
    )
    return row.select(
        "raw_rows",
        "valid_rows",
        (F.col("raw_rows") - F.col("valid_rows")).alias("removed_rows"),
        (F.col("valid_rows") / F.nullif("raw_rows", F.lit(0))).alias("retention_rate"),
        "original_missing_rows",
        "reclassified_rows",
        (F.col("original_missing_rows") + F.col("reclassified_rows")).alias("rows_for_imputation"),
        "positive_label_rows",
        (F.col("positive_label_rows") / F.nullif("valid_rows", F.lit(0))).alias("positive_label_rate"),
    )


def rule_violations(
    df: DataFrame, rules: Mapping[str, Column], evidence: Sequence[str] = ()
) -> DataFrame:
    """Rows per named violation with min and max of the evidence columns, one pass."""
    return df.agg(
        F.count("*").alias("row_count"),
        *[F.count_if(condition).alias(f"{name}_rows") for name, condition in rules.items()],
        *[F.min(c).alias(f"{c}_min") for c in evidence],
        *[F.max(c).alias(f"{c}_max") for c in evidence],
    )


def exclusion_overlap(
    df: DataFrame,
    negative: Column,
    voided: Column,
    over_limit: Column,
    outside_period: Column,
) -> DataFrame:
    """How many rows each exclusion hits, alone and together. Null conditions count as no hit."""
    a, b, c, d = [F.coalesce(x, F.lit(False)) for x in (negative, voided, over_limit, outside_period)]
    return df.agg(
        F.count_if(d).alias("outside_period_rows"),
        F.count_if(a).alias("negative_rows"),
        F.count_if(b).alias("voided_rows"),
        F.count_if(a & b).alias("overlap_rows"),
        F.count_if(c).alias("over_limit_rows"),
        F.count_if(a | b | c).alias("unique_excluded_rows"),
    )


def negative_in(columns: Sequence[str]) -> Column:
    return any_of([F.coalesce(F.col(c) < 0, F.lit(False)) for c in columns])


def over_limit(limits: Mapping[str, float]) -> Column:
    return any_of([F.coalesce(F.col(c) > v, F.lit(False)) for c, v in limits.items()])


def sum_consistency(df: DataFrame, parts: Sequence[str], total: str, tolerance: float = 0.01) -> DataFrame:
    """On complete rows: row count, mean |total - sum of parts|, share within the tolerance."""
    gap = F.abs(F.col(total) - row_sum(parts, nulls="all"))
    return df.dropna(subset=[*parts, total]).agg(
        F.count("*").alias("row_count"),
        F.avg(gap).alias("mean_absolute_difference"),
        F.avg((gap <= tolerance).cast("int")).alias("within_tolerance_ratio"),
    )


def null_cells(df: DataFrame) -> DataFrame:
    """Number of null cells in the whole table."""
    return df.agg(F.coalesce(F.sum(_null_count(df.columns)), F.lit(0)).alias("null_cells"))


def assert_no_nulls(df: DataFrame) -> DataFrame:
    """The same table; raises when a null is left."""
    left = null_cells(df).first()["null_cells"]
    if left:
        raise ValueError(f"{left} null cells are left after filling")
    return df


def leakage_guard(features: Sequence[str], forbidden: Sequence[str], declared: Sequence[str] | None = None) -> None:
    """Raise when a feature is part of the target, or the order differs from the declared one."""
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"features leak the target: {leaked}")
    if declared is not None and list(features) != list(declared):
        raise ValueError("the feature order differs from the declared list")


def expected_rows(df: DataFrame, expected: int, name: str = "table") -> None:
    """Raise when the row count is not the pinned one."""
    actual = df.count()
    if actual != expected:
        raise ValueError(f"{name} has {actual} rows, expected {expected}")


def audit_running_rows(counted: DataFrame, order: str, removed: str, total: int) -> DataFrame:
    """before_rows and after_rows from removed rows per step (a small result table)."""
    upto = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gone = F.sum(removed).over(upto)
    return counted.withColumn("before_rows", F.lit(total) - gone + F.col(removed)).withColumn(
        "after_rows", F.lit(total) - gone
    )
