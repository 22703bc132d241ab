"""Imputers, scalers and category encoders: fit on the training side, apply to any side.

Each is an Estimator/Model pair, so they mix with MLlib stages. States of a few numbers
are params and are saved with the model. States with one row per category are measured
tables, joined by broadcast under the session's limit and by salted key beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline.functions.prefix import running_total
from ledgerline.functions.quantiles import column_quantiles
from ledgerline.functions.sizing import lookup_join, measured
from ledgerline.operators.splits import fold_number


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns", TypeConverters.toListString)

    def columns(self) -> list[str]:
        return list(self.getOrDefault(self.inputCols))


class _TableWriter(MLWriter):
    def __init__(self, model: "_TableModel") -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, {"tables": sorted(self.model.tables)})
        for name, table in self.model.tables.items():
            table.write.parquet(f"{path}/tables/{name}")


class _TableReader(MLReader):
    def __init__(self, kind: type) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "_TableModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {
            name: measured(self.sparkSession.read.parquet(f"{path}/tables/{name}")) for name in metadata["tables"]
        }
        model = self.kind(tables=tables)
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _TableModel(Model, _Columns, MLWritable, MLReadable):
    """A model whose state is one row per category; saved as Parquet beside its params."""

    suffix = Param(Params._dummy(), "suffix", "ending of the output columns", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] = (), tables: dict[str, DataFrame] | None = None,
                 suffix: str = "") -> None:
        super().__init__()
        self._set(inputCols=list(columns), suffix=suffix)
        self.tables = dict(tables or {})

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _filled(column: str, value: str, kind: str) -> Column:
    """Null replaced; an integer column becomes double when the value has a fraction."""
    if kind not in INTEGRAL:
        return F.coalesce(F.col(column), F.lit(value).cast(kind))
    number = float(value)
    if not number.is_integer():
        return F.coalesce(F.col(column).cast("double"), F.lit(number))
    whole = int(value) if value.lstrip("-").isdigit() else int(number)
    return F.coalesce(F.col(column), F.lit(whole).cast(kind))


class FillModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fills null from fitted values; flag columns mark what was null."""

    fillValues = Param(Params._dummy(), "fillValues", "one value per column, as text")
    flagCols = Param(Params._dummy(), "flagCols", "columns with a 0/1 flag", TypeConverters.toListString)

    def __init__(self, columns: Sequence[str] = (), values: Sequence = (), flags: Sequence[str] = ()) -> None:
        super().__init__()
        self._set(inputCols=list(columns), fillValues=[None if v is None else str(v) for v in values],
                  flagCols=list(flags))

    def values(self) -> dict[str, str]:
        return dict(zip(self.columns(), self.getOrDefault(self.fillValues), strict=True))

    def _transform(self, df: DataFrame) -> DataFrame:
        types = dict(df.dtypes)
        new = {c: _filled(c, v, types[c]) for c, v in self.values().items() if v is not None}
        for c in self.getOrDefault(self.flagCols):
            new[f"{c}_missing"] = F.col(c).isNull().cast("int")
        return df.withColumns(new)


class MedianImputer(Estimator, _Columns):
    """Exact interpolated training median per column; flags where training had nulls."""

    def __init__(self, columns: Sequence[str], indicator: bool = True) -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.indicator = indicator

    def _fit(self, df: DataFrame) -> FillModel:
        columns = self.columns()
        medians = {r["column"]: r["q0"] for r in column_quantiles(df, columns, [0.5]).collect()}
        flags = []
        if self.indicator:
            nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
            flags = [c for c in columns if nulls[c]]
        return FillModel(columns, [medians.get(c) for c in columns], flags)


def column_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest on a tie.

    Counted per (column, value) with map-side combine; text, integers and doubles in one
    pass each.
    """
    types = dict(df.dtypes)
    modes: dict[str, object] = {c: None for c in columns}
    groups: dict[str, list[str]] = {}
    for c in columns:
        kind = "STRING" if types[c] == "string" else "BIGINT" if types[c] in INTEGRAL else "DOUBLE"
        groups.setdefault(kind, []).append(c)
    for kind, group in groups.items():
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS {kind})" for c in group)
        counted = (
            df.selectExpr(f"stack({len(group)}, {pairs}) AS (column, value)")
            .where(F.col("value").isNotNull())
            .groupBy("column", "value")
            .agg(F.count("*").alias("n"))
        )
        top = counted.groupBy("column").agg(F.min(F.struct(-F.col("n"), "value")).alias("best"))
        for row in top.select("column", "best.value").collect():
            modes[row["column"]] = row["value"]
    return modes


class ModeImputer(Estimator, _Columns):
    """Training mode per column, the smallest value on a tie."""

    def __init__(self, columns: Sequence[str]) -> None:
        super().__init__()
        self._set(inputCols=list(columns))

    def _fit(self, df: DataFrame) -> FillModel:
        modes = column_modes(df, self.columns())
        return FillModel(self.columns(), [modes[c] for c in self.columns()])


class ConstantImputer(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """One constant for all columns; a text constant turns codes into text first."""

    fillValue = Param(Params._dummy(), "fillValue", "constant, as text", TypeConverters.toString)
    asText = Param(Params._dummy(), "asText", "cast columns to string", TypeConverters.toBoolean)

    def __init__(self, columns: Sequence[str] = (), value: object = 0, as_text: bool | None = None) -> None:
        super().__init__()
        self._set(inputCols=list(columns), fillValue=str(value),
                  asText=isinstance(value, str) if as_text is None else as_text)

    def _transform(self, df: DataFrame) -> DataFrame:
        types = dict(df.dtypes)
        text = self.getOrDefault(self.asText)
        new = {}
        for c in self.columns():
            kind = "string" if text else types[c]
            new[c] = F.coalesce(F.col(c).cast(kind), F.lit(self.getOrDefault(self.fillValue)).cast(kind))
        return df.withColumns(new)


class ScaleModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """(x - mean) / population deviation; a constant column is only centred."""

    means = Param(Params._dummy(), "means", "training means", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "training deviations", TypeConverters.toListFloat)

    def __init__(self, columns: Sequence[str] = (), means: Sequence[float] = (),
                 deviations: Sequence[float] = ()) -> None:
        super().__init__()
        self._set(inputCols=list(columns), means=list(means), deviations=list(deviations))

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(self.columns(), self.getOrDefault(self.means), self.getOrDefault(self.deviations),
                     strict=True)
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(d) for c, m, d in fitted})


class PopulationScaler(Estimator, _Columns):
    """Standard scaling with the population deviation of the training rows."""

    def __init__(self, columns: Sequence[str]) -> None:
        super().__init__()
        self._set(inputCols=list(columns))

    def _fit(self, df: DataFrame) -> ScaleModel:
        columns = self.columns()
        row = df.agg(
            *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(columns)],
        ).first()
        means = [row[f"_m{i}"] or 0.0 for i in range(len(columns))]
        deviations = [row[f"_s{i}"] or 1.0 for i in range(len(columns))]
        return ScaleModel(columns, means, deviations)


def _long_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return (
        df.selectExpr(f"stack({len(list(columns))}, {pairs}) AS (column, category)")
        .where(F.col("category").isNotNull())
        .groupBy("column", "category")
        .agg(F.count("*").alias("train_rows"))
    )


class CategoryEncoder(Estimator, _Columns):
    """Training vocabulary per column, with an infrequent class below ``min_frequency``.

    The model maps each column to its category, to the infrequent class, or to null for
    an unknown one; unknown values join the infrequent class when the column has one.
    """

    INFREQUENT = "infrequent"

    def __init__(self, columns: Sequence[str], min_frequency: int | None = None) -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.min_frequency = min_frequency

    def _fit(self, df: DataFrame) -> "CategoryModel":
        counts = _long_counts(df, self.columns())
        rare = F.col("train_rows") < (self.min_frequency or 0)
        table = counts.withColumn("mapped", F.when(rare, F.lit(self.INFREQUENT)).otherwise(F.col("category")))
        return CategoryModel(self.columns(), {"categories": measured(table)})


class CategoryModel(_TableModel):
    @property
    def table(self) -> DataFrame:
        return self.tables["categories"]

    def rare_columns(self) -> set[str]:
        rare = self.table.where(F.col("mapped") != F.col("category")).select("column").distinct()
        return {r["column"] for r in rare.collect()}

    def vocabulary(self) -> DataFrame:
        """column, mapped category, training rows, slot (alphabetical position in its column)."""
        categories = self.table.groupBy("column", F.col("mapped").alias("category")).agg(
            F.sum("train_rows").alias("train_rows"), F.lit(1).alias("_one")
        )
        placed = running_total(categories, ["column", "category"], "_one", "_upto")
        starts = placed.groupBy("column").agg(F.min("_upto").alias("_start"))
        return placed.join(starts, "column").select(
            "column", "category", "train_rows", (F.col("_upto") - F.col("_start")).alias("slot")
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        with_rare = self.rare_columns()
        for c in self.columns():
            part = self.table.where(F.col("column") == c).select(
                F.col("category").alias("_category"), F.col("mapped").alias("_mapped")
            )
            joined = lookup_join(df.withColumn("_category", F.col(c).cast("string")), part, ["_category"])
            mapped = F.col("_mapped")
            if c in with_rare:
                mapped = F.coalesce(
                    mapped, F.when(F.col("_category").isNotNull(), F.lit(CategoryEncoder.INFREQUENT))
                )
            df = joined.withColumn(c, mapped).drop("_category", "_mapped")
        return df

    def one_hot_long(self, df: DataFrame, ids: Sequence[str], drop_first: bool = False) -> DataFrame:
        """ids, column, category, slot of the ones in the one-hot matrix; unknown gives no row."""
        mapped = self.transform(df.select(*ids, *self.columns()))
        pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in self.columns())
        long = mapped.selectExpr(*ids, f"stack({len(self.columns())}, {pairs}) AS (column, category)")
        slots = measured(self.vocabulary().select("column", "category", "slot"))
        ones = lookup_join(long.where(F.col("category").isNotNull()), slots, ["column", "category"])
        return ones.where(F.col("slot") > 0) if drop_first else ones


class OrdinalEncoder(Estimator, _Columns):
    """Sorted training categories become 0..k-1; unknown becomes -1, null stays null."""

    def __init__(self, columns: Sequence[str], suffix: str = "_index") -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.suffix = suffix

    def _fit(self, df: DataFrame) -> "OrdinalModel":
        tables = {}
        for c in self.columns():
            distinct = df.select(F.col(c).alias("_category")).where(F.col(c).isNotNull()).distinct()
            counted = running_total(distinct.withColumn("_one", F.lit(1)), ["_category"], "_one", "_upto")
            tables[c] = measured(counted.select("_category", (F.col("_upto") - 1).cast("int").alias("_index")))
        return OrdinalModel(self.columns(), tables, self.suffix)


class OrdinalModel(_TableModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns():
            joined = lookup_join(df.withColumn("_category", F.col(c)), self.tables[c], ["_category"])
            index = F.when(F.col(c).isNotNull(), F.coalesce("_index", F.lit(-1)))
            df = joined.withColumn(c + self.getOrDefault(self.suffix), index).drop("_category", "_index")
        return df


DRIVER_CATEGORIES = 10_000  # per column; beyond it the vocabulary stays a table


class VocabularyIndexer(Estimator, _Columns):
    """Sorted training categories, as text, become 0..k-1; unknown and null become k.

    One scan estimates the distinct values of all columns. Up to ``limit`` a ``StringIndexer``
    holds them; beyond it the codes are dense ranks over range-partitioned blocks and stay a
    table that rows are joined to. The codes are the same.
    """

    def __init__(self, columns: Sequence[str], suffix: str = "__index", limit: int = DRIVER_CATEGORIES) -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.suffix, self.limit = suffix, limit

    def _fit(self, df: DataFrame) -> Model:
        columns = self.columns()
        distinct = df.agg(*[F.approx_count_distinct(c, 0.02).alias(f"_{i}") for i, c in enumerate(columns)]).first()
        if max(distinct) <= self.limit:
            return StringIndexer(
                inputCols=columns, outputCols=[c + self.suffix for c in columns],
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ).fit(df)
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        tables = OrdinalEncoder(columns).fit(texts).tables
        return VocabularyModel(columns, tables, self.suffix)


class VocabularyModel(_TableModel):
    """Codes from tables of categories; the index columns carry only the number of codes."""

    def _transform(self, df: DataFrame) -> DataFrame:
        for c in self.columns():
            name, size = c + self.getOrDefault(self.suffix), self.tables[c].count()
            joined = lookup_join(df.withColumn("_category", F.col(c).cast("string")), self.tables[c], ["_category"])
            coded = joined.withColumn(name, F.coalesce("_index", F.lit(size)).cast("double")).drop("_category", "_index")
            df = coded.withMetadata(name, {"ml_attr": {"type": "nominal", "name": name, "num_vals": size + 1}})
        return df


class HotAssembler(Estimator, _Columns):
    """One vector of the input columns and a slot per known category of each index column.

    Columns indexed from a table get no slot names: the vector is built from (slot, value)
    pairs, as names would bring the vocabulary into the plan.
    """

    def __init__(self, columns: Sequence[str], indexed: Sequence[str], output: str) -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.indexed, self.output = list(indexed), output

    def _fit(self, df: DataFrame) -> Model:
        known = [df.schema[c].metadata.get("ml_attr", {}) for c in self.indexed]
        if any("vals" not in attribute for attribute in known):
            sizes = [len(a["vals"]) if "vals" in a else a["num_vals"] for a in known]
            return SparseAssembler(self.columns(), self.indexed, [k - 1 for k in sizes], self.output)
        # The dropped last slot is the unknown one, so unknown and null are all zeros.
        hot = [f"{c}__hot" for c in self.indexed]
        names = ", ".join(f"`{c}`" for c in hot)
        return Pipeline(stages=[
            OneHotEncoder(inputCols=self.indexed, outputCols=hot, dropLast=True),
            VectorAssembler(inputCols=[*self.columns(), *hot], outputCol=self.output, handleInvalid="error"),
            SQLTransformer(statement=f"SELECT * EXCEPT ({names}) FROM __THIS__"),
        ]).fit(df)


class SparseAssembler(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A sparse vector from numbers and codes, by column functions; a null number is an error."""

    indexCols = Param(Params._dummy(), "indexCols", "columns of codes", TypeConverters.toListString)
    sizes = Param(Params._dummy(), "sizes", "known codes per column", TypeConverters.toListInt)
    outputCol = Param(Params._dummy(), "outputCol", "the vector", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] = (), indexed: Sequence[str] = (), sizes: Sequence[int] = (),
                 output: str = "") -> None:
        super().__init__()
        self._set(inputCols=list(columns), indexCols=list(indexed), sizes=list(sizes), outputCol=output)

    def _transform(self, df: DataFrame) -> DataFrame:
        pair = lambda slot, value: F.struct(slot.cast("int").alias("slot"), value.cast("double").alias("value"))
        pairs = []
        for place, c in enumerate(self.columns()):
            number = F.coalesce(F.col(c).cast("double"), F.raise_error(F.lit(f"null in {c}")).cast("double"))
            pairs.append(pair(F.lit(place), number))
        offset = len(pairs)
        for c, size in zip(self.getOrDefault(self.indexCols), self.getOrDefault(self.sizes), strict=True):
            pairs.append(pair(F.lit(offset) + F.col(c), (F.col(c) < size).cast("double")))
            offset += size
        held = F.filter(F.array(*pairs), lambda p: p["value"] != 0.0)
        # The vector type's own struct form, read back as that type.
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"), F.lit(offset).alias("size"),
            F.transform(held, lambda p: p["slot"]).alias("indices"), F.transform(held, lambda p: p["value"]).alias("values"),
        )
        typed = F.from_json(F.to_json(F.struct(vector.alias("v"))), StructType([StructField("v", VectorUDT())]))
        return df.withColumn(self.getOrDefault(self.outputCol), typed["v"])


class TargetEncoder(Estimator, _Columns):
    """Mean of the target per category, shrunk to the global mean by its own variance.

    Weight n*t2 / (n*t2 + s2) with the population variances t2 of the target and s2 within
    the category (empirical Bayes; Micci-Barreca 2001). ``fit_transform_crossfit`` encodes
    each training row without its own fold, by subtracting fold sums from total sums.
    """

    def __init__(self, columns: Sequence[str], target: str, suffix: str = "_mean") -> None:
        super().__init__()
        self._set(inputCols=list(columns))
        self.target, self.suffix = target, suffix

    def _fit(self, df: DataFrame) -> "TargetModel":
        overall = df.agg(F.avg(self.target).alias("mean"), F.var_pop(self.target).alias("var")).first()
        tables = {}
        for c in self.columns():
            sums = df.groupBy(F.col(c).alias("_category")).agg(
                F.count(self.target).alias("_n"),
                F.avg(self.target).alias("_mean"),
                F.var_pop(self.target).alias("_var"),
            )
            encoding = _shrunk("_n", "_mean", "_var", F.lit(overall["mean"]), F.lit(overall["var"]))
            tables[c] = measured(
                sums.where(F.col("_category").isNotNull() & (F.col("_n") > 0)).select(
                    "_category", encoding.alias("_encoding")
                )
            )
        return TargetModel(self.columns(), tables, self.suffix, float(overall["mean"]))

    def fit_transform_crossfit(
        self, df: DataFrame, ids: Sequence[str], folds: int = 5, seed: int = 42
    ) -> DataFrame:
        """Training rows with out-of-fold encodings."""
        y = F.col(self.target)
        folded = df.withColumn("_fold", fold_number(ids, folds, seed))
        centre = df.agg(F.avg(y)).first()[0]  # sums of squares around it keep their digits
        z = y - F.lit(centre)
        sums = [F.count(y).alias("_n"), F.sum(z).alias("_s"), F.sum(z * z).alias("_q")]
        by_fold = measured(folded.groupBy("_fold").agg(*sums))
        total = by_fold.agg(F.sum("_n").alias("n"), F.sum("_s").alias("s"), F.sum("_q").alias("q")).first()
        left = by_fold.select(
            "_fold",
            (F.lit(total["n"]) - F.col("_n")).alias("_gn"),
            (F.lit(total["s"]) - F.col("_s")).alias("_gs"),
            (F.lit(total["q"]) - F.col("_q")).alias("_gq"),
        )
        outer = F.broadcast(left)  # one row per fold
        encoded = folded
        for c in self.columns():
            per = folded.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_category"), "_fold").agg(*sums)
            per = measured(per)
            whole = per.groupBy("_category").agg(
                F.sum("_n").alias("_tn"), F.sum("_s").alias("_ts"), F.sum("_q").alias("_tq")
            )
            rest = per.join(whole, "_category").join(outer, "_fold")
            n, s, q = F.col("_tn") - F.col("_n"), F.col("_ts") - F.col("_s"), F.col("_tq") - F.col("_q")
            safe = F.nullif(n, F.lit(0))
            mean_c, var_c = s / safe, F.greatest(q / safe - (s / safe) * (s / safe), F.lit(0.0))
            mean_g = F.col("_gs") / F.col("_gn")
            var_g = F.greatest(F.col("_gq") / F.col("_gn") - mean_g * mean_g, F.lit(0.0))
            table = measured(
                rest.select("_category", "_fold", n.alias("_rn"), mean_c.alias("_mean"), var_c.alias("_var"),
                            mean_g.alias("_g"), var_g.alias("_gv"))
                .select("_category", "_fold",
                        (_shrunk("_rn", "_mean", "_var", F.col("_g"), F.col("_gv")) + F.lit(centre)).alias("_encoding"))
            )
            joined = lookup_join(encoded.withColumn("_category", F.col(c)), table, ["_category", "_fold"])
            fallback = reduce(
                lambda chain, r: chain.when(F.col("_fold") == r["_fold"], F.lit(r["_gs"] / r["_gn"] + centre)),
                left.collect(),
                F.when(F.lit(False), F.lit(0.0)),
            )
            encoded = joined.withColumn(
                f"{c}{self.suffix}", F.coalesce("_encoding", fallback)
            ).drop("_category", "_encoding")
        return encoded.drop("_fold")


def _shrunk(n: str, mean: str, var: str, global_mean: Column, global_var: Column) -> Column:
    weight = F.col(n) * global_var / F.nullif(F.col(n) * global_var + F.col(var), F.lit(0.0))
    weight = F.coalesce(weight, F.lit(1.0))
    return F.when(F.col(n) > 0, weight * F.col(mean) + (1 - weight) * global_mean).otherwise(global_mean)


class TargetModel(_TableModel):
    overallMean = Param(Params._dummy(), "overallMean", "training mean", TypeConverters.toFloat)

    def __init__(self, columns: Sequence[str] = (), tables: dict[str, DataFrame] | None = None,
                 suffix: str = "", mean: float = 0.0) -> None:
        super().__init__(columns, tables, suffix)
        self._set(overallMean=mean)

    def _transform(self, df: DataFrame) -> DataFrame:
        mean = F.lit(self.getOrDefault(self.overallMean))
        for c in self.columns():
            joined = lookup_join(df.withColumn("_category", F.col(c)), self.tables[c], ["_category"])
            df = joined.withColumn(
                c + self.getOrDefault(self.suffix), F.coalesce("_encoding", mean)
            ).drop("_category", "_encoding")
        return df
