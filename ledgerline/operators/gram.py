"""Least squares from one table of sums.

A scan of the training rows gives, per fold, the sums of products of all pairs of columns:
measures, their null marks, one slot per category, targets. Everything after that is linear
algebra on the driver. Filling with a median is adding the median times the null mark; scaling
divides a column's sums; merging rare categories or a mode adds slots; leaving a fold out
subtracts its table. So one scan serves every fold, target, penalty and preparation.

Rows with categories too many for such a table go to ``sparse_least_squares``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.expressions import row_sum
from ledgerline.functions.quantiles import column_quantiles
from ledgerline.operators.encoders import CategoryEncoder
from ledgerline.operators.quality import leakage_guard
from ledgerline.operators.splits import kfold_assign

SLOTS = 1024  # widest table of sums: 8 MB of doubles
RANK_TOLERANCE = 1e-11
ONE, MEASURE, NULL, CATEGORY, TARGET, TOO_WIDE = "one", "measure", "null", "category", "target", "too wide"
SUMS = "fold int, known bigint, left_kind string, left_column string, left_value string, right_kind string, right_column string, right_value string, total double"
KEY = [c.split()[0] for c in SUMS.split(", ")[:-1]]


def known_number(df: DataFrame, column: str) -> Column:
    """The column as a double; NaN counts as unknown."""
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number) if dict(df.dtypes)[column] in ("double", "float") else number


def partial_sums(numeric: Sequence[str], categorical: Sequence[str], targets: Sequence[str], slots: int):
    """Function from Arrow batches of a task to the sums of its rows, one row per pair that occurs."""
    plain = [(ONE, "", None), *[(MEASURE, c, None) for c in numeric], *[(NULL, c, None) for c in numeric], *[(TARGET, t, None) for t in targets]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dense: dict[tuple, np.ndarray] = {}
        by_slot: dict[tuple, np.ndarray] = {}
        together: dict[tuple, dict[int, int]] = {}
        vocabulary: list[dict] = [{} for _ in categorical]
        wide = False
        for batch in batches:
            x = batch[[f"x{i}" for i in range(len(numeric))]].to_numpy(np.float64)
            y = batch[[f"y{i}" for i in range(len(targets))]].to_numpy(np.float64)
            known = (~np.isnan(y)) @ (1 << np.arange(len(targets)))
            z = np.hstack([np.ones((len(batch), 1)), np.nan_to_num(x), np.isnan(x), np.nan_to_num(y)])
            codes = []
            for i, words in enumerate(vocabulary):
                local, values = pd.factorize(batch[f"c{i}"], use_na_sentinel=False)
                place = [words.setdefault(None if pd.isna(v) else v, len(words)) for v in values]
                codes.append(np.array(place, np.int64)[local])
            wide = wide or sum(map(len, vocabulary)) > slots
            groups = batch["fold"].to_numpy(np.int64) << 32 | known
            for group in np.unique(groups):
                rows = groups == group
                part, key = z[rows], (int(group >> 32), int(group & 0xFFFFFFFF))
                dense[key] = dense.get(key, 0) + part.T @ part
                if wide:
                    continue
                for i, words in enumerate(vocabulary):
                    own = codes[i][rows]
                    sums = np.stack([np.bincount(own, weights=column, minlength=len(words)) for column in part.T], axis=1)
                    before = by_slot.get((*key, i))
                    if before is not None:
                        sums[:len(before)] += before
                    by_slot[(*key, i)] = sums
                    for j in range(i):
                        pairs, counts = np.unique(codes[j][rows] << 32 | own, return_counts=True)
                        tally = together.setdefault((*key, j, i), {})
                        for pair, count in zip(pairs.tolist(), counts.tolist()):
                            tally[pair] = tally.get(pair, 0) + count
        made = []
        for key, table in dense.items():
            made += [(*key, *plain[i], *plain[j], table[i, j]) for i in range(len(plain)) for j in range(i, len(plain))]
        if wide:
            made.append((0, 0, TOO_WIDE, "", None, TOO_WIDE, "", None, 1.0))
        else:
            words = [list(w) for w in vocabulary]
            for (*key, i), table in by_slot.items():
                for slot, sums in enumerate(table):
                    made += [(*key, *plain[k], CATEGORY, categorical[i], words[i][slot], s) for k, s in enumerate(sums) if s]
            for (*key, j, i), tally in together.items():
                made += [
                    (*key, CATEGORY, categorical[j], words[j][p >> 32], CATEGORY, categorical[i], words[i][p & 0xFFFFFFFF], float(n))
                    for p, n in tally.items()
                ]
        yield pd.DataFrame(made, columns=[*KEY, "total"])

    return run


@dataclass(frozen=True)
class Gram:
    """Sums of products per fold, as a table on the driver."""

    table: pd.DataFrame
    numeric: Sequence[str]
    categorical: Sequence[str]
    targets: Sequence[str]
    medians: Mapping[tuple, float]

    def matrix(self, target: str, without: int | None = None) -> tuple[np.ndarray, dict]:
        """Sums over the rows whose target is known, and the place of each column or category."""
        bit = 1 << list(self.targets).index(target)
        rows = self.table[(self.table["known"].to_numpy(np.int64) & bit) > 0]
        if without is not None:
            rows = rows[rows["fold"] != without]
        places: dict[tuple, int] = {}
        sides = []
        for side in ("left", "right"):
            keys = zip(*[rows[f"{side}_{part}"] for part in ("kind", "column", "value")])
            sides.append([places.setdefault((k, c, None if pd.isna(v) else v), len(places)) for k, c, v in keys])
        sums = np.zeros((len(places), len(places)))
        np.add.at(sums, tuple(sides), rows["total"].to_numpy())
        both = sums + sums.T
        np.fill_diagonal(both, sums.diagonal())
        for (kind, column, value), place in places.items():  # slots of one column never meet
            if kind == CATEGORY:
                both[place, place] = both[place, places[ONE, "", None]]
        return both, places

    def solve(self, preparation, target: str, alpha: float | None, intercept: bool = True,
              without: int | None = None, prediction: str = "prediction", log_target: bool = False) -> "LinearColumns":
        """Weights that minimise squares plus ``alpha * |w|^2``; None is the solution of smallest norm."""
        sums, places = self.matrix(target, without)
        if not places:
            raise ValueError(f"{target} has no known answers")
        one, answer = places[ONE, "", None], places[TARGET, target, None]
        n = sums[one, one]
        columns: list[tuple[str, str, dict[int, float]]] = []
        numeric: dict[str, dict] = {}
        for c in [*preparation.numeric, *preparation.passthrough]:
            x, null = places[MEASURE, c, None], places[NULL, c, None]
            fill = self._fill(preparation, c, sums[one, null], (without, target))
            spec = numeric[c] = {"fill": fill, "shift": 0.0, "scale": 1.0, "weight": 0.0, "flag": 0.0}
            value = {x: 1.0} if fill is None else {x: 1.0, null: fill}
            if preparation.scale and c in preparation.numeric:
                mean = sum(k * sums[one, p] for p, k in value.items()) / n
                square = sum(k * l * sums[p, q] for p, k in value.items() for q, l in value.items()) / n
                spread = square - mean * mean
                spec["shift"] = mean
                spec["scale"] = float(np.sqrt(spread)) if spread > 1e-15 * square else 1.0
                value = {**{p: k / spec["scale"] for p, k in value.items()}, one: -mean / spec["scale"]}
            columns.append((MEASURE, c, value))
            if preparation.indicator and c in preparation.numeric and sums[one, null]:
                columns.append((NULL, c, {null: 1.0}))
        words: dict[str, dict] = {}
        for c in preparation.categorical:
            spec, slots = self._categories(preparation, c, sums, places, one)
            words[c] = spec
            columns += [(CATEGORY, json.dumps([c, name]), value) for name, value in sorted(slots.items())]
        turn = np.zeros((len(sums), len(columns)))
        for k, (_, _, value) in enumerate(columns):
            for p, weight in value.items():
                turn[p, k] = weight
        squares, products = turn.T @ sums @ turn, turn.T @ sums[:, answer]
        means, middle = turn.T @ sums[:, one] / n, sums[one, answer] / n
        if intercept:
            squares = squares - n * np.outer(means, means)
            products = products - n * means * middle
        weights = solved(squares, products, alpha)
        constant = middle - means @ weights if intercept else 0.0
        for (kind, name, _), weight in zip(columns, weights.tolist()):
            if kind == CATEGORY:
                column, value = json.loads(name)
                words[column]["weights"][value] = weight
            else:
                numeric[name]["weight" if kind == MEASURE else "flag"] = weight
        return LinearColumns(prediction, float(constant), numeric, words, log_target)

    def _fill(self, preparation, column: str, nulls: float, side: tuple) -> float | None:
        if column in preparation.passthrough or preparation.numeric_fill is None:
            if nulls:
                raise ValueError(f"{column} has nulls and nothing fills them")
            return None
        if preparation.numeric_fill != "median":
            return float(preparation.numeric_fill)
        return float(self.medians.get((*side, column)) or 0.0)

    def _categories(self, preparation, column: str, sums: np.ndarray, places: dict, one: int) -> tuple[dict, dict]:
        """How values map to slots, and the raw places that make up each slot."""
        counts = {v: sums[one, p] for (k, c, v), p in places.items() if k == CATEGORY and c == column and sums[one, p]}
        fill = preparation.categorical_fill
        if fill == "mode":
            known = [v for v in counts if v is not None]
            number = pd.to_numeric(pd.Series(known, dtype=object), errors="coerce")
            order = sorted(range(len(known)), key=lambda i: (-counts[known[i]], number[i] if number.notna().all() else 0, known[i]))
            fill = known[order[0]] if known else None
        elif isinstance(fill, Mapping):
            fill = fill.get(column)
        fill = None if fill is None else str(fill)
        slots: dict[str, dict[int, float]] = {}
        filled: dict[str, float] = {}
        for value, count in counts.items():
            if (name := fill if value is None else value) is not None:
                filled[name] = filled.get(name, 0) + count
        rare = {name for name, count in filled.items() if count < (preparation.min_frequency or 0)}
        for value in counts:
            if (name := fill if value is None else value) is not None:
                slot = CategoryEncoder.INFREQUENT if name in rare else name
                slots.setdefault(slot, {})[places[CATEGORY, column, value]] = 1.0
        return {"fill": fill, "rare": sorted(rare), "weights": {}}, slots


def solved(squares: np.ndarray, products: np.ndarray, alpha: float | None) -> np.ndarray:
    """Ridge weights; without a penalty the solution of smallest norm, also of dependent columns."""
    if not len(products):
        return np.zeros(0)
    if alpha:
        return np.linalg.solve(squares + alpha * np.eye(len(products)), products)
    values, vectors = np.linalg.eigh(squares)
    kept = values > RANK_TOLERANCE * max(values.max(), 0.0)
    inverse = np.divide(1.0, values, out=np.zeros_like(values), where=kept)
    return vectors @ (inverse * (vectors.T @ products))


class LinearColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A linear prediction as one column expression on the unprepared columns."""

    spec = Param(Params._dummy(), "spec", "weights and how columns are prepared, as JSON", TypeConverters.toString)

    def __init__(self, prediction: str = "prediction", constant: float = 0.0, numeric: Mapping | None = None,
                 categories: Mapping | None = None, log_target: bool = False) -> None:
        super().__init__()
        self._set(spec=json.dumps({
            "prediction": prediction, "constant": constant, "numeric": numeric or {}, "categories": categories or {},
            "log_target": log_target,
        }))

    def expression(self, df: DataFrame) -> Column:
        spec = json.loads(self.getOrDefault(self.spec))
        total = F.lit(spec["constant"])
        for c, s in spec["numeric"].items():
            value = known_number(df, c)
            missing = value.isNull().cast("double")
            if s["fill"] is None:
                value = F.coalesce(value, F.raise_error(F.lit(f"{c} is null and nothing fills it")).cast("double"))
            else:
                value = F.coalesce(value, F.lit(s["fill"]))
            total = total + F.lit(s["weight"]) * ((value - F.lit(s["shift"])) / F.lit(s["scale"]))
            if s["flag"]:
                total = total + F.lit(s["flag"]) * missing
        for c, s in spec["categories"].items():
            weights, rare = s["weights"], s["weights"].get(CategoryEncoder.INFREQUENT)
            value = F.col(c).cast("string")
            value = value if s["fill"] is None else F.coalesce(value, F.lit(s["fill"]))
            found = None
            known = [(v, w) for v, w in weights.items() if v != CategoryEncoder.INFREQUENT or not s["rare"]]
            if known:
                table = F.map_from_arrays(F.array(*[F.lit(v) for v, _ in known]), F.array(*[F.lit(w) for _, w in known]))
                found = F.try_element_at(table, value)
            other = F.when(value.isNotNull(), F.lit(rare)).otherwise(0.0) if s["rare"] and rare is not None else F.lit(0.0)
            total = total + (other if found is None else F.coalesce(found, other))
        return F.expm1(total) if spec["log_target"] else total

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(json.loads(self.getOrDefault(self.spec))["prediction"], self.expression(df))


def gram_table(df: DataFrame, preparation, targets: Sequence[str], fold: str | None = None, slots: int = SLOTS) -> Gram | None:
    """The table of sums of ``df``, per value of ``fold``; None if its categories do not fit.

    Map-side sums of a task are one row per pair of slots that occurs in it. Medians, where
    asked for, are taken in further passes, of columns with nulls alone.
    """
    leakage_guard(preparation.columns(), preparation.forbidden)
    numeric, categorical = [*preparation.numeric, *preparation.passthrough], list(preparation.categorical)
    if len(targets) > 31:
        raise ValueError("a table of sums holds up to 31 targets")
    narrow = df.select(
        (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"),
        *[known_number(df, c).alias(f"x{i}") for i, c in enumerate(numeric)],
        *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(categorical)],
        *[known_number(df, t).alias(f"y{i}") for i, t in enumerate(targets)],
    )
    parts = narrow.mapInPandas(partial_sums(numeric, categorical, list(targets), slots), SUMS)
    table = parts.groupBy(*KEY).agg(F.sum("total").alias("total")).toPandas()
    found = table[table["right_kind"] == CATEGORY][["right_column", "right_value"]].drop_duplicates()
    if (table["left_kind"] == TOO_WIDE).any() or len(found) + 2 * len(numeric) + len(targets) > slots:
        return None
    medians: dict[tuple, float] = {}
    marked = table[(table["left_kind"] == ONE) & (table["right_kind"] == NULL) & (table["total"] > 0)]
    empty = sorted(set(marked["right_column"]) & set(preparation.numeric))
    if preparation.numeric_fill == "median" and empty:
        partly = len(table["known"].unique()) > 1
        for without in [None] if fold is None else sorted(table["fold"].unique().tolist()):
            rows = df if without is None else df.where(F.col(fold) != without)
            for target in targets if partly else targets[:1]:
                found = column_quantiles(rows.where(known_number(df, target).isNotNull()), empty, [0.5]).collect()
                medians |= {(without, t, r["column"]): r["q0"] for r in found for t in ([target] if partly else targets)}
    return Gram(table, numeric, categorical, list(targets), medians)


def cross_validate_ridge(df: DataFrame, ids: Sequence[str], targets: Sequence[str], preparation, alpha: float | None = 10.0,
                         folds: int = 5, total: str = "total") -> DataFrame:
    """Scores of ``cross_validate`` for least squares: one scan for all fits, one for all scores."""
    folded = kfold_assign(df, ids, folds)
    gram = gram_table(folded, preparation, targets, "fold")
    if gram is None:
        raise ValueError("too many categories for a table of sums")
    models = {t: [gram.solve(preparation, t, alpha, without=k) for k in range(folds)] for t in targets}
    chosen = {
        t: F.element_at(F.array(*[m.expression(df) for m in fitted]), F.col("fold") + 1) for t, fitted in models.items()
    }
    pairs = {t: (known_number(df, t), chosen[t]) for t in targets}
    answers = folded.select("fold", *[c.alias(f"{k}{i}") for i, pair in enumerate(pairs.values()) for k, c in zip("yp", pair)])
    last = len(targets)
    whole = {k: row_sum([f"{k}{i}" for i in range(last)]) for k in "yp"}
    answers = answers.withColumns({f"{k}{last}": c for k, c in whole.items()})
    names = [*targets, total]
    stats = []
    for i, name in enumerate(names):
        known = F.col(f"y{i}").isNotNull()
        error = F.when(known, F.col(f"p{i}") - F.col(f"y{i}"))
        stats.append(F.struct(
            F.lit(name).alias("target"), F.count(f"y{i}").alias("row_count"), F.avg(F.abs(error)).alias("mae"),
            F.avg(error * error).alias("mse"), F.var_pop(f"y{i}").alias("variance"),
        ))
    per_fold = answers.groupBy("fold").agg(F.array(*stats).alias("s")).select("fold", F.inline("s")).where("row_count > 0")
    r2 = 1 - F.col("mse") / F.nullif(F.col("variance"), F.lit(0.0))
    return per_fold.groupBy("target").agg(
        F.count("*").alias("folds"), F.sum("row_count").alias("row_count"), F.avg(r2).alias("r2_mean"),
        F.stddev_pop(r2).alias("r2_std"), F.avg("mae").alias("mae_mean"), F.avg(F.sqrt("mse")).alias("rmse_mean"),
    )
