"""Least squares over sparse rows by conjugate gradients, for category columns of any width.

The vocabulary is a table: each (column, category) gets a slot by dense ranks over range
partitions and never comes to the driver as names. A row is its measures and the slots of its
categories. A step multiplies the centred matrix and its transpose by a vector: tasks read
the vector, which is broadcast, and return sums per slot, which merge. Steps end when the
residual of the normal equations is small beside its start; a fit that does not get there fails.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.prefix import running_total
from ledgerline.functions.quantiles import column_quantiles
from ledgerline.functions.sizing import lookup_join, measured, spread
from ledgerline.operators.encoders import CategoryEncoder, _TableModel, column_modes
from ledgerline.operators.gram import known_number
from ledgerline.operators.quality import leakage_guard

TOLERANCE = 1e-10
STEPS = 2000
WIDEST = 1 << 23  # doubles of a vector: 64 MB, broadcast with every step


def filled_categories(df: DataFrame, preparation) -> tuple[DataFrame, dict]:
    """Category columns as filled strings, and the fills."""
    columns, fill = list(preparation.categorical), preparation.categorical_fill
    if fill == "mode":
        fills = column_modes(df, columns)
    elif isinstance(fill, dict):
        fills = {c: fill.get(c) for c in columns}
    else:
        fills = dict.fromkeys(columns, fill)
    return with_fills(df, fills), fills


def with_fills(df: DataFrame, fills: dict) -> DataFrame:
    return df.withColumns({
        c: F.col(c).cast("string") if v is None else F.coalesce(F.col(c).cast("string"), F.lit(str(v))) for c, v in fills.items()
    })


def slot_table(df: DataFrame, columns: Sequence[str], first: int, min_frequency: int | None = None) -> DataFrame:
    """column, category and slot from ``first`` on; categories below ``min_frequency`` share their column's slot."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    counts = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, category)").where("category IS NOT NULL").groupBy(
        "column", "category"
    ).agg(F.count("*").alias("n"))
    rare = F.col("n") < (min_frequency or 0)
    named = counts.withColumn("mapped", F.when(rare, F.lit(CategoryEncoder.INFREQUENT)).otherwise(F.col("category")))
    distinct = named.groupBy("column", "mapped").agg(F.lit(1).alias("one"))
    placed = running_total(distinct, ["column", "mapped"], "one", "upto").select(
        "column", "mapped", (F.col("upto") + (first - 1)).cast("int").alias("slot")
    )
    return measured(named.join(placed, ["column", "mapped"]).select("column", "category", "mapped", "slot"))


def with_slots(df: DataFrame, columns: Sequence[str], table: DataFrame) -> DataFrame:
    """Adds ``slots``: those of the row's known categories, by one lookup per column."""
    for i, c in enumerate(columns):
        part = measured(table.where(F.col("column") == c).select(F.col("category").alias(f"_category{i}"), F.col("slot").alias(f"_slot{i}")))
        df = lookup_join(df.withColumn(f"_category{i}", F.col(c)), part, [f"_category{i}"]).drop(f"_category{i}")
    names = [f"_slot{i}" for i in range(len(columns))]
    return df.withColumn("slots", F.filter(F.array(*names), lambda s: s.isNotNull())).drop(*names)


def sparse_parts(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Measures, the row of each one in the sparse part, its slot, and the answers."""
    x = np.array(batch["x"].tolist(), np.float64).reshape(len(batch), -1)
    sizes = batch["slots"].map(len).to_numpy()
    slots = np.concatenate([*batch["slots"], np.zeros(0, np.int64)]).astype(np.int64)
    return x, np.repeat(np.arange(len(batch)), sizes), slots, batch["y"].to_numpy(np.float64)


def summed(rows: DataFrame, width: int, value) -> np.ndarray:
    """Sum over the rows of ``value(x, row, slot, y)``, a vector with ``width`` places.

    Each task adds up a vector of its own and returns the places that are not zero.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(width)
        for batch in batches:
            total += value(*sparse_parts(batch))
        places = np.flatnonzero(total)
        yield pd.DataFrame({"place": places, "amount": total[places]})

    found = rows.mapInPandas(run, "place bigint, amount double").groupBy("place").agg(F.sum("amount").alias("amount")).toPandas()
    out = np.zeros(width)
    out[found["place"].to_numpy(np.int64)] = found["amount"].to_numpy()
    return out


def conjugate_gradients(multiply, start: np.ndarray, scale: np.ndarray, tolerance: float = TOLERANCE, steps: int = STEPS) -> np.ndarray:
    """Solves ``multiply(w) = start`` from zero; ``scale`` divides the residual (Jacobi)."""
    weights, residual = np.zeros_like(start), start.copy()
    goal = tolerance * np.linalg.norm(start)
    ready = residual / scale
    direction, size = ready.copy(), residual @ ready
    for _ in range(steps):
        if np.linalg.norm(residual) <= goal:
            return weights
        image = multiply(direction)
        length = size / (direction @ image)
        weights += length * direction
        residual -= length * image
        ready = residual / scale
        size, before = residual @ ready, size
        direction = ready + size / before * direction
    raise RuntimeError(f"least squares did not converge in {steps} steps")


def sparse_least_squares(train: DataFrame, preparation, target: str, alpha: float | None, intercept: bool = True,
                         prediction: str = "prediction", log_target: bool = False) -> "SparseLinear":
    """The same minimum as from a table of sums, by steps over kept sparse rows."""
    leakage_guard(preparation.columns(), preparation.forbidden)
    known = train.where(known_number(train, target).isNotNull())
    columns = [*preparation.numeric, *preparation.passthrough]
    numbers = known.select(
        *[known_number(train, c).alias(c) for c in columns], *preparation.categorical, known_number(train, target).alias("_answer")
    )
    fill = preparation.numeric_fill
    medians = {r["column"]: r["q0"] for r in column_quantiles(numbers, preparation.numeric, [0.5]).collect()} if fill == "median" and preparation.numeric else {}
    fills = [medians.get(c) if fill == "median" else fill if c in preparation.numeric else None for c in columns]
    filled = numbers.withColumns({c: F.coalesce(F.col(c), F.lit(float(v))) for c, v in zip(columns, fills) if v is not None})
    filled, named = filled_categories(filled, preparation)
    facts = filled.agg(*[f(c).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in (("m", F.avg), ("s", F.stddev_pop), ("n", F.count))], F.count("*").alias("n"), F.avg("_answer").alias("y")).first()
    n, middle = facts["n"], facts["y"]
    if any(facts[f"n{i}"] < n for i in range(len(columns))):
        raise ValueError("a measure has nulls and nothing fills them")
    scaled = [preparation.scale and c in preparation.numeric for c in columns]
    shifts = [facts[f"m{i}"] if s else 0.0 for i, s in enumerate(scaled)]
    scales = [(facts[f"s{i}"] or 1.0) if s else 1.0 for i, s in enumerate(scaled)]
    k = len(columns)
    table = slot_table(filled, preparation.categorical, k, preparation.min_frequency)
    width = max(k, (table.agg(F.max("slot")).first()[0] or k - 1) + 1)
    if width > WIDEST:
        raise ValueError(f"{width} columns are more than a broadcast vector of {WIDEST} holds")
    x = F.array(*[(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(columns, shifts, scales)]) if columns else F.expr("CAST(array() AS array<double>)")
    rows = with_slots(filled.select(*preparation.categorical, x.alias("x"), F.col("_answer").alias("y")), preparation.categorical, table)
    kept = spread(rows.select("x", "slots", "y")).persist(StorageLevel.MEMORY_AND_DISK)
    context = train.sparkSession.sparkContext

    def back(x, row, slot, per_row):
        """Transpose times a number per row."""
        out = np.bincount(slot, weights=per_row[row], minlength=width)[:width].astype(np.float64)
        out[:k] += x.T @ per_row
        return out

    def multiply(vector: np.ndarray) -> np.ndarray:
        sent = context.broadcast(vector)
        shift = float(means @ vector)
        try:
            def value(x, row, slot, y):
                v = sent.value
                ahead = x @ v[:k] + np.bincount(row, weights=v[slot], minlength=len(y)) - shift
                return np.append(back(x, row, slot, ahead), ahead.sum())

            got = summed(kept, width + 1, value)
        finally:
            sent.destroy()
        return got[:width] - means * got[width] + (alpha or 0.0) * vector

    try:
        sums = summed(kept, 2 * width, lambda x, row, slot, y: np.append(back(x, row, slot, np.ones(len(y))), back(x * x, row, slot, np.ones(len(y)))))
        means = sums[:width] / n if intercept else np.zeros(width)
        diagonal = sums[width:] - n * means ** 2 + (alpha or 0.0)
        scale = np.maximum(diagonal, 1e-300) if alpha else np.ones(width)
        shift_y = middle if intercept else 0.0
        start = summed(kept, width + 1, lambda x, row, slot, y: np.append(back(x, row, slot, y - shift_y), (y - shift_y).sum()))
        weights = conjugate_gradients(multiply, start[:width] - means * start[width], scale)
    finally:
        kept.unpersist()
    constant = float(middle - means @ weights) if intercept else 0.0
    by_slot = train.sparkSession.createDataFrame(pd.DataFrame({"slot": np.arange(k, width, dtype=np.int32), "weight": weights[k:]}))
    named_weights = table.join(by_slot, "slot").select("column", "category", "mapped", "weight")
    spec = {
        "prediction": prediction, "constant": constant, "log_target": log_target, "fills": fills, "shifts": shifts, "scales": scales,
        "weights": weights[:k].tolist(), "columns": columns, "categories": list(preparation.categorical),
        "named": {c: None if v is None else str(v) for c, v in named.items()},
    }
    return SparseLinear(spec, {"weights": measured(named_weights)})


class SparseLinear(_TableModel):
    """A linear prediction whose category weights are a table."""

    spec = Param(Params._dummy(), "spec", "weights of measures and fills", TypeConverters.identity)

    def __init__(self, spec: dict | None = None, tables: dict[str, DataFrame] | None = None) -> None:
        super().__init__((spec or {}).get("columns", ()), tables)
        self._set(spec=spec or {})

    def _transform(self, df: DataFrame) -> DataFrame:
        spec, names = self.getOrDefault(self.spec), df.columns
        total: Column = F.lit(spec["constant"])
        for c, fill, shift, scale, weight in zip(*[spec[p] for p in ("columns", "fills", "shifts", "scales", "weights")]):
            value = known_number(df, c)
            value = value if fill is None else F.coalesce(value, F.lit(float(fill)))
            total = total + F.lit(weight) * ((value - F.lit(shift)) / F.lit(scale))
        rows = df
        for i, c in enumerate(spec["categories"]):
            own = self.tables["weights"].where(F.col("column") == c)
            rare = own.where(F.col("mapped") != F.col("category")).agg(F.max("weight")).first()[0]
            part = measured(own.select(F.col("category").alias(f"_category{i}"), F.col("weight").alias(f"_weight{i}")))
            value = F.col(c).cast("string")
            fill = spec["named"][c]
            value = value if fill is None else F.coalesce(value, F.lit(fill))
            rows = lookup_join(rows.withColumn(f"_category{i}", value), part, [f"_category{i}"])
            other = F.lit(0.0) if rare is None else F.when(F.col(f"_category{i}").isNotNull(), F.lit(rare)).otherwise(0.0)
            total = total + F.coalesce(F.col(f"_weight{i}"), other)
        result = F.expm1(total) if spec["log_target"] else total
        return rows.withColumn(spec["prediction"], result).select(*names, spec["prediction"])
