"""Tabular models on MLlib: fit on the training side, predict every given row.

Training data is scanned many times by the iterative learners, so the prepared feature
rows are persisted (memory, then disk) for the length of one fit.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    IndexToString,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.concurrent import together
from ledgerline.functions.expressions import row_sum
from ledgerline.functions.quantiles import column_quantiles, median_value
from ledgerline.functions.sizing import spread, spread_small
from ledgerline.operators.boosting import BoostedTrees, BoostedTreesModel, joint_scores
from ledgerline.operators.encoders import (
    DRIVER_CATEGORIES,
    CategoryEncoder,
    ConstantImputer,
    HotAssembler,
    MedianImputer,
    ModeImputer,
    OrdinalEncoder,
    PopulationScaler,
    VocabularyIndexer,
    column_modes,
)
from ledgerline.operators.evaluation import (
    classification_metrics,
    multi_target_eval,
    part_sum_mae,
    regression_metrics,
    roc_auc,
)
from ledgerline.operators.gram import gram_table
from ledgerline.operators.quality import leakage_guard
from ledgerline.operators.sparse_squares import sparse_least_squares
from ledgerline.operators.softmax import SoftmaxTrees, fit_softmax
from ledgerline.operators.splits import kfold_assign
from ledgerline.operators.trees import fit_vector_forest
from ledgerline.session import use_checkpoints

FEATURES = "features"
PREDICTION = "prediction"


# Preprocessing -------------------------------------------------------------------------


@dataclass(frozen=True)
class Preprocessing:
    """Column groups and how each is prepared."""

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    passthrough: Sequence[str] = ()
    numeric_fill: str | float | None = "median"
    indicator: bool = False  # a 0/1 column per numeric one that marks its nulls
    categorical_fill: str | float | Mapping[str, object] | None = "mode"  # a mapping has one constant per column
    scale: bool = True
    one_hot: bool = True
    ordinal: bool = False  # codes as numbers in sorted order, -1 for values training never saw
    min_frequency: int | None = None
    driver_categories: int = DRIVER_CATEGORIES  # a column with more keeps its vocabulary in a table
    forbidden: Sequence[str] = field(default=())

    def columns(self) -> list[str]:
        return [*self.numeric, *self.categorical, *self.passthrough]

    def flags(self) -> list[str]:
        return [f"{c}__missing" for c in self.numeric] if self.indicator else []

    def stages(self) -> list[Estimator | Transformer]:
        """Working copies, imputers, scaler, encoders and the final vector.

        The input columns stay as they are, so that several models can score the same rows.
        """
        leakage_guard(self.columns(), self.forbidden)
        copies = ", ".join(f"`{c}` AS `{c}__in`" for c in self.columns())
        stages: list[Estimator | Transformer] = [SQLTransformer(statement=f"SELECT *, {copies} FROM __THIS__")]
        numeric = [f"{c}__in" for c in self.numeric]
        categorical = [f"{c}__in" for c in self.categorical]
        if numeric and self.indicator:
            flags = ", ".join(f"CAST(`{c}` IS NULL AS int) AS `{c}__missing`" for c in self.numeric)
            stages.append(SQLTransformer(statement=f"SELECT *, {flags} FROM __THIS__"))
        if numeric and self.numeric_fill == "median":
            stages.append(MedianImputer(numeric, indicator=False))
        elif numeric and self.numeric_fill is not None:
            stages.append(ConstantImputer(numeric, self.numeric_fill))
        if numeric and self.scale:
            stages.append(PopulationScaler(numeric))
        inputs = [*numeric, *self.flags(), *[f"{c}__in" for c in self.passthrough]]
        if categorical:
            if isinstance(self.categorical_fill, Mapping):
                stages += [ConstantImputer([f"{c}__in"], value) for c, value in self.categorical_fill.items()]
            elif self.categorical_fill == "mode":
                stages.append(ModeImputer(categorical))
            elif self.categorical_fill is not None:
                stages.append(ConstantImputer(categorical, self.categorical_fill))
            if self.min_frequency:
                stages.append(CategoryEncoder(categorical, self.min_frequency))
            indexed = [f"{c}__in__index" for c in self.categorical]
            if self.ordinal:
                stages.append(OrdinalEncoder(categorical, suffix="__index"))
            else:
                stages.append(VocabularyIndexer(categorical, limit=self.driver_categories))
            if self.one_hot and not self.ordinal:
                return [*stages, HotAssembler(inputs, indexed, FEATURES)]
            inputs += indexed
        stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="error"))
        return stages

    def tidy(self) -> SQLTransformer:
        """Removes the vector and the working columns after the model."""
        made = [FEATURES, *[f"{c}__in" for c in self.columns()], *self.flags(), *[f"{c}__in__index" for c in self.categorical]]
        names = ", ".join(f"`{c}`" for c in made)
        return SQLTransformer(statement=f"SELECT * EXCEPT ({names}) FROM __THIS__")


def assemble(train: DataFrame, preprocessing: Preprocessing) -> PipelineModel:
    """Fitted preprocessing that ends in one vector column."""
    return Pipeline(stages=preprocessing.stages()).fit(train)


@contextmanager
def kept(df: DataFrame):
    """Rows that are scanned several times, in memory then on disk, for the length of a block."""
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()


def fit_model(train: DataFrame, preprocessing: Preprocessing, learner: Estimator, target: str,
              after: Sequence[Transformer] = (), weight: str | None = None) -> PipelineModel:
    """Preprocessing and learner fitted on the same kept rows, as one saveable model."""
    use_checkpoints(train.sparkSession)
    needed = dict.fromkeys([*preprocessing.columns(), target, *([weight] if weight else [])])
    dealt = spread_small if isinstance(learner, (BoostedTrees, LogisticRegression)) else spread
    with kept(dealt(train.where(F.col(target).isNotNull()).select(*needed))) as rows:
        prepared = assemble(rows, preprocessing)
        made = prepared.transform(rows).select(FEATURES, target, *([weight] if weight else []))
        if isinstance(learner, (BoostedTrees, LogisticRegression)):  # keep their rows themselves, in blocks
            fitted = learner.fit(made)
        else:
            with kept(made) as vectors:
                fitted = enough_bins(learner, vectors).fit(vectors)
    return PipelineModel([*prepared.stages, fitted, preprocessing.tidy(), *after])


def enough_bins(estimator: Estimator, vectors: DataFrame) -> Estimator:
    """The tree learner with bins for every value of its widest code column."""
    if not estimator.hasParam("maxBins"):
        return estimator
    nominal = vectors.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    widest = max((len(a["vals"]) if "vals" in a else a.get("num_vals", 0) for a in nominal), default=0)
    estimator.set(estimator.getParam("maxBins"), max(estimator.getOrDefault("maxBins"), widest))
    return estimator


# Learners ------------------------------------------------------------------------------


def baseline_constant(train: DataFrame, test: DataFrame, target: str, kind: str = "mean",
                      prediction: str = PREDICTION) -> DataFrame:
    """Test rows with the training mean, median or mode as the prediction."""
    if kind == "mean":
        value = train.agg(F.avg(target)).first()[0]
    elif kind == "median":
        value = median_value(train, target)
    elif kind == "mode":
        value = column_modes(train, [target])[target]
    else:
        raise ValueError(f"unknown baseline: {kind}")
    return test.withColumn(prediction, F.lit(value).cast("double"))


def fit_linear(train: DataFrame, preprocessing: Preprocessing, target: str,
               prediction: str = PREDICTION) -> PipelineModel:
    """Ordinary least squares.

    Full one-hot groups beside an intercept are linearly dependent; this is the least-squares
    solution of smallest norm.
    """
    return fit_ridge(train, preprocessing, target, alpha=None, prediction=prediction)


def fit_ridge(train: DataFrame, preprocessing: Preprocessing, target: str, alpha: float | None = 10.0,
              log_target: bool = False, fit_intercept: bool = True,
              prediction: str = PREDICTION) -> PipelineModel:
    """Least squares with ``alpha * |w|^2`` added to the sum of squares.

    One scan makes the table of sums the weights are solved from. Categories that do not fit
    into it are solved for by conjugate gradients over sparse rows.
    """
    if preprocessing.categorical and (preprocessing.ordinal or not preprocessing.one_hot):
        raise ValueError("least squares takes one slot per category")
    label = f"_log_{target}" if log_target else target
    frame = train.withColumn(label, F.log1p(F.col(target))) if log_target else train
    gram = gram_table(frame, preprocessing, [label])
    if gram is not None:
        return PipelineModel([gram.solve(preprocessing, label, alpha, fit_intercept, None, prediction, log_target)])
    return PipelineModel([sparse_least_squares(frame, preprocessing, label, alpha, fit_intercept, prediction, log_target)])


def gradient_boosting(target: str, trees: int = 100, step: float = 0.05, depth: int = 5,
                      max_bins: int = 320, seed: int = 42) -> BoostedTrees:
    """Of squared errors; nothing is drawn, so ``seed`` changes nothing."""
    return BoostedTrees("squares", FEATURES, target, trees, step, depth, max_bins, PREDICTION)


def boosted_classifier(target: str, trees: int = 200, step: float = 0.1, depth: int = 5,
                       max_bins: int = 320, seed: int = 42) -> BoostedTrees:
    """Binary only; see ``fit_softmax_trees`` for several classes."""
    return BoostedTrees("logistic", FEATURES, target, trees, step, depth, max_bins, PREDICTION)


def fit_softmax_trees(train: DataFrame, preprocessing: Preprocessing, target: str, rounds: int = 200, step: float = 0.1,
                      depth: int = 5, min_leaf: int = 20, max_bins: int = 255, prediction: str = PREDICTION,
                      after: Sequence[Transformer] = ()) -> PipelineModel:
    """One boosted model for all classes, numbers from 0; see ``softmax``."""
    use_checkpoints(train.sparkSession)
    with kept(spread_small(train.where(F.col(target).isNotNull()).select(*dict.fromkeys([*preprocessing.columns(), target])))) as rows:
        prepared = assemble(rows, preprocessing)
        vectors = prepared.transform(rows)
        fitted = fit_softmax(vectors, FEATURES, target, rounds, step, depth, min_leaf, max_bins, prediction=prediction)
    return PipelineModel([*prepared.stages, fitted, preprocessing.tidy(), *after])


def forest_classifier(target: str, trees: int = 50, depth: int = 8, max_bins: int = 320,
                      seed: int = 42, prediction: str = PREDICTION) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES, labelCol=target, predictionCol=prediction, numTrees=trees,
        maxDepth=depth, maxBins=max_bins, seed=seed,
    )


def random_forest(target: str, trees: int = 80, depth: int = 15, min_leaf: int = 50,
                  max_bins: int = 320, seed: int = 42, prediction: str = PREDICTION) -> RandomForestRegressor:
    """``min_leaf`` keeps deep trees on many rows from growing without bound."""
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol=prediction, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed, subsamplingRate=1.0,
        maxMemoryInMB=512,
    )


def fit_forest_multi(train: DataFrame, preprocessing: Preprocessing, targets: Sequence[str],
                     trees: int = 80, depth: int = 15, min_leaf: int = 50,
                     max_bins: int = 256, seed: int = 42, draw: bool = True) -> PipelineModel:
    """One forest whose trees split for all targets at once; columns ``<target>_prediction``."""
    use_checkpoints(train.sparkSession)
    with kept(spread(train.select(*dict.fromkeys([*preprocessing.columns(), *targets])))) as rows:
        prepared = assemble(rows, preprocessing)
        vectors = prepared.transform(rows)
        forest = fit_vector_forest(vectors, FEATURES, targets, trees, depth, min_leaf, max_bins, seed, draw)
    return PipelineModel([*prepared.stages, forest, preprocessing.tidy()])


def sum_of_targets(predicted: DataFrame, targets: Sequence[str], total: str = "total_prediction") -> DataFrame:
    """Row sum of the per-target predictions."""
    return predicted.withColumn(total, row_sum([f"{t}_prediction" for t in targets]))


# Per-target bundles --------------------------------------------------------------------


@dataclass(frozen=True)
class Bundle:
    """A per-target model: regression, two_stage or classification."""

    kind: str
    parts: Mapping[str, PipelineModel]

    def predict(self, df: DataFrame, output: str) -> DataFrame:
        """The input columns with the predicted amount."""
        return _with_amounts(df, {output: self})


_MAIN = {"regression": "regressor", "two_stage": "regressor", "classification": "classifier"}


def _with_amounts(df: DataFrame, bundles: Mapping[str, Bundle]) -> DataFrame:
    """The input columns with each bundle's amount; all parts are scored in one Python step.

    A model has its preprocessing, the learner, the step that tidies up, and what follows it.
    """
    names, models = df.columns, {}
    for output, bundle in bundles.items():
        if bundle.kind not in _MAIN:
            raise ValueError(f"unknown model kind: {bundle.kind}")
        models |= {(output, part): list(model.stages) for part, model in bundle.parts.items()}
    rows, scorings, learners, after = df, [], {}, {}
    for i, (place, stages) in enumerate(models.items()):
        at = next(k for k, stage in enumerate(stages) if isinstance(stage, (BoostedTreesModel, SoftmaxTrees)))
        vectors = [f"_vector_{k}" for k in range(i)]
        rows = PipelineModel(stages[:at]).transform(rows).select(*names, *vectors, F.col(FEATURES).alias(f"_vector_{i}"))
        learners[place], after[place] = stages[at], stages[at + 2:]
        scorings.append(stages[at].scoring(f"_vector_{i}"))
    answers = {place: f"_answer_{i}" for i, place in enumerate(models)}
    rows = rows.select(*names, joint_scores(rows, scorings).alias("_scores"))
    rows = rows.select(*names, *[learners[p].answer(F.col("_scores")[i]).alias(c) for i, (p, c) in enumerate(answers.items())])
    for output, bundle in bundles.items():
        before = rows.columns
        main = output, _MAIN[bundle.kind]
        amount = F.greatest(F.col(answers[main]), F.lit(0.0))
        if bundle.kind == "two_stage":
            amount = F.when(F.col(answers[output, "classifier"]) == 1.0, amount).otherwise(0.0)
        elif bundle.kind == "classification":
            rows = PipelineModel(after[main]).transform(rows.withColumn(PREDICTION, F.col(answers[main])))
            amount = F.col("_label_text").cast("double")
        rows = rows.select(*before, amount.alias(output))
    return rows.drop(*answers.values())


def fit_continuous_target(train: DataFrame, preprocessing: Preprocessing, target: str,
                          trees: int = 250, max_bins: int = 320) -> Bundle:
    known = train.where(F.col(target).isNotNull())
    model = fit_model(known, preprocessing, gradient_boosting(target, trees, 0.1, max_bins=max_bins), target)
    return Bundle("regression", {"regressor": model})


def fit_two_stage_target(train: DataFrame, preprocessing: Preprocessing, target: str,
                         trees: int = 200, max_bins: int = 320) -> Bundle:
    """Whether there is an amount, then how much on the rows that have one."""
    known = train.where(F.col(target).isNotNull())
    charged = known.withColumn("_charged", (F.col(target) > 0).cast("double"))
    positive = known.where(F.col(target) > 0)
    classifier, regressor = together(train.sparkSession, [
        lambda: fit_model(charged, preprocessing, boosted_classifier("_charged", trees, max_bins=max_bins), "_charged"),
        lambda: fit_model(positive, preprocessing, gradient_boosting(target, trees, 0.1, max_bins=max_bins), target),
    ])
    return Bundle("two_stage", {"classifier": classifier, "regressor": regressor})


def fit_fixed_amount_target(train: DataFrame, preprocessing: Preprocessing, target: str,
                            trees: int = 200, max_bins: int = 255) -> Bundle:
    """Classes are the distinct training amounts; the predicted class maps back to its amount."""
    known = train.where(F.col(target).isNotNull()).withColumn("_amount_text", F.col(target).cast("string"))
    labels = StringIndexer(inputCol="_amount_text", outputCol="_label", stringOrderType="alphabetAsc").fit(known)
    back = IndexToString(inputCol=PREDICTION, outputCol="_label_text", labels=labels.labels)
    model = fit_softmax_trees(labels.transform(known), preprocessing, "_label", trees, max_bins=max_bins, after=[back])
    return Bundle("classification", {"classifier": model})


FITTERS: dict[str, Callable[..., Bundle]] = {
    "regression": fit_continuous_target,
    "two_stage": fit_two_stage_target,
    "classification": fit_fixed_amount_target,
}


def predict_bundles(bundles: Mapping[str, Bundle], df: DataFrame) -> DataFrame:
    """``<target>_prediction`` for each bundle and their row sum; row-local, no shuffle."""
    return sum_of_targets(_with_amounts(df, {f"{t}_prediction": b for t, b in bundles.items()}), list(bundles))


def evaluate_bundles(train: DataFrame, test: DataFrame, bundles: Mapping[str, Bundle],
                     total: str | None = None) -> DataFrame:
    """Per target: kind, metrics, baseline MAE, and F1 or accuracy where they apply; plus the total."""
    scored = predict_bundles(bundles, test)
    with kept(scored) as predicted:
        table = multi_target_eval(predicted, {t: f"{t}_prediction" for t in bundles}, total)
        rows = {r["target"]: r.asDict() for r in table.collect()}
        coded = [t for t, b in bundles.items() if b.kind == "classification"]
        measures = [t for t in bundles if t not in coded]
        with kept(train.select(*bundles)) as answers:  # all modes in one pass, all medians in one
            constants = column_modes(answers, coded) if coded else {}
            if measures:
                constants |= {r["column"]: r["q0"] for r in column_quantiles(answers, measures, [0.5]).collect()}
        for target, bundle in bundles.items():
            row, prediction = rows[target], f"{target}_prediction"
            known = predicted.where(F.col(target).isNotNull())
            row["kind"] = bundle.kind
            classes, baseline = bundle.kind == "classification", constants.get(target)
            row["baseline_mae"] = known.agg(F.avg(F.abs(F.col(target) - F.lit(baseline)))).first()[0]
            if classes:
                # An amount unseen in training is simply wrong.
                scores = classification_metrics(known, target, prediction, baseline=baseline).first()
                row.update({k: scores[k] for k in ("accuracy", "weighted_f1", "baseline_accuracy")})
            elif bundle.kind == "two_stage":
                flags = known.select(
                    (F.col(target) > 0).cast("int").alias("a"), (F.col(prediction) > 0).cast("int").alias("p")
                )
                row["charge_f1"] = classification_metrics(flags, "a", "p").first()["binary_f1"]
        if total is not None:
            rows[total]["part_sum_mae"] = part_sum_mae(predicted, list(bundles), total).first()["component_sum_mae"]
    schema = (
        "target string, kind string, row_count long, mae double, rmse double, r2 double, "
        "baseline_mae double, accuracy double, weighted_f1 double, baseline_accuracy double, "
        "charge_f1 double, part_sum_mae double"
    )
    names = [c.strip().split(" ")[0] for c in schema.split(",")]
    return train.sparkSession.createDataFrame([tuple(r.get(c) for c in names) for r in rows.values()], schema)


# Comparison and validation -------------------------------------------------------------


def compare_models(train: DataFrame, test: DataFrame, target: str,
                   variants: Mapping[str, Callable[[DataFrame], Transformer]]) -> DataFrame:
    """experiment and metrics of each variant on the same split."""
    rows = []
    with kept(spread_small(train)) as train_rows, kept(test) as test_rows:
        for name, fit in variants.items():
            with kept(fit(train_rows).transform(test_rows).select(target, PREDICTION)) as scored:
                rows.append((name, *regression_metrics(scored, target, PREDICTION).first()))
    return train.sparkSession.createDataFrame(
        rows, "experiment string, row_count long, mae double, rmse double, median_ae double, r2 double"
    )


class ConstantModel(Transformer):
    """Predicts one number."""

    def __init__(self, value: float) -> None:
        super().__init__()
        self.value = value

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PREDICTION, F.lit(self.value).cast("double"))


def per_target_benchmark(train: DataFrame, test: DataFrame, targets: Sequence[str],
                         fit: Callable[[DataFrame, str], Transformer]) -> DataFrame:
    """The same features for each target; unknown answers are left out, never filled."""
    rows = []
    with kept(spread_small(train)) as train_rows, kept(test) as test_rows:
        for target in targets:
            known = F.col(target).isNotNull()
            train_valid, test_valid = train_rows.where(known), test_rows.where(known)
            facts = test_valid.agg(
                F.count("*"), F.avg(target), F.avg((F.col(target) != 0).cast("int"))
            ).first()
            train_count = train_valid.count()
            if not train_count or not facts[0]:
                raise ValueError(f"{target} has no known answers on a side")
            started = time.perf_counter()
            model = fit(train_valid, target)
            seconds = time.perf_counter() - started
            with kept(model.transform(test_valid).select(target, PREDICTION)) as scored:
                m = regression_metrics(scored, target, PREDICTION).first()
            rows.append((target, train_count, *facts, m["mae"], m["rmse"], m["median_ae"], m["r2"], seconds))
    return train.sparkSession.createDataFrame(
        rows,
        "target string, train_rows long, test_rows long, test_mean double, test_nonzero_rate double, "
        "mae double, rmse double, median_ae double, r2 double, fit_seconds double",
    )


def cross_validate(df: DataFrame, ids: Sequence[str], targets: Sequence[str],
                   fit: Callable[[DataFrame], Transformer], folds: int = 5, total: str = "total") -> DataFrame:
    """Per target over k folds: mean and population deviation of R2, mean MAE and RMSE.

    Preprocessing and model are refitted on each fold's training rows, a few folds at a time.
    ``total`` compares the summed predictions with the summed targets.
    """
    with kept(spread(kfold_assign(df, ids, folds).withColumn(total, row_sum(targets)))) as folded:
        folded.count()  # kept before the folds start, so that they share it and know its size

        def scores(k: int) -> list[tuple]:
            model = fit(folded.where(F.col("fold") != k).drop("fold"))
            with kept(model.transform(folded.where(F.col("fold") == k))) as predicted:
                table = multi_target_eval(predicted, {t: f"{t}_prediction" for t in targets}, total)
                return [(k, *r) for r in table.collect()]  # one row per target and fold

        rows = [r for part in together(df.sparkSession, [lambda k=k: scores(k) for k in range(folds)]) for r in part]
    per_fold = df.sparkSession.createDataFrame(
        rows, "fold int, target string, row_count long, mae double, rmse double, r2 double"
    )
    return per_fold.groupBy("target").agg(
        F.count("*").alias("folds"),
        F.sum("row_count").alias("row_count"),
        F.avg("r2").alias("r2_mean"),
        F.stddev_pop("r2").alias("r2_std"),
        F.avg("mae").alias("mae_mean"),
        F.avg("rmse").alias("rmse_mean"),
    )


def high_value_classifier(train: DataFrame, test: DataFrame, preprocessing: Preprocessing,
                          label: str, balanced: bool = True) -> DataFrame:
    """Logistic regression on a 0/1 label: accuracy, precision, recall, F1 and ROC AUC."""
    weighted = train.withColumn(label, F.col(label).cast("double"))
    if balanced:
        shares = weighted.agg(F.count(label).alias("n"), F.sum(label).alias("ones")).first()
        up = shares["n"] / (2.0 * max(shares["ones"], 1.0))
        down = shares["n"] / (2.0 * max(shares["n"] - shares["ones"], 1.0))
        weighted = weighted.withColumn("weight", F.when(F.col(label) == 1.0, up).otherwise(down))
    learner = LogisticRegression(featuresCol=FEATURES, labelCol=label, predictionCol=PREDICTION,
                                 **({"weightCol": "weight"} if balanced else {}))
    model = fit_model(weighted, preprocessing, learner, label, weight="weight" if balanced else None)
    with kept(model.transform(test.withColumn(label, F.col(label).cast("double")))) as scored:
        auc = roc_auc(scored.select(label, vector_to_array("probability")[1].alias("score")), label, "score").first()["roc_auc"]
        hit = F.count_if((F.col(label) == 1) & (F.col(PREDICTION) == 1))
        row = scored.agg(
            F.count("*").alias("row_count"),
            F.avg((F.col(label) == F.col(PREDICTION)).cast("int")).alias("accuracy"),
            F.coalesce(hit / F.nullif(F.count_if(F.col(PREDICTION) == 1), F.lit(0)), F.lit(0.0)).alias("precision"),
            F.coalesce(hit / F.nullif(F.count_if(F.col(label) == 1), F.lit(0)), F.lit(0.0)).alias("recall"),
        ).first()
    both = row["precision"] + row["recall"]
    f1 = 2 * row["precision"] * row["recall"] / both if both else 0.0
    return train.sparkSession.createDataFrame(
        [(*row, f1, auc)],
        "row_count long, accuracy double, precision double, recall double, f1 double, roc_auc double",
    )


# Persistence ---------------------------------------------------------------------------


def compare_predictions(left: DataFrame, right: DataFrame, ids: Sequence[str],
                        prediction: str = PREDICTION) -> DataFrame:
    """Rows matched by id and the largest difference of their predictions."""
    a = left.select(*ids, F.col(prediction).alias("_a"))
    b = right.select(*ids, F.col(prediction).alias("_b"))
    return a.join(b, list(ids)).agg(
        F.count("*").alias("row_count"), F.max(F.abs(F.col("_a") - F.col("_b"))).alias("max_difference")
    )


def model_roundtrip(model: PipelineModel, df: DataFrame, ids: Sequence[str], path: str) -> DataFrame:
    """Save, load and compare the predictions of both models."""
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return compare_predictions(model.transform(df), loaded.transform(df), ids)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def save_bundles(spark: SparkSession, bundles: Mapping[str, Bundle], features: Sequence[str], path: str) -> None:
    """One saved model per part, and a manifest written last."""
    for target, bundle in bundles.items():
        for part, model in bundle.parts.items():
            model.write().overwrite().save(f"{path}/{target}/{part}")
    manifest = {
        "features": list(features),
        "targets": {t: {"kind": b.kind, "parts": sorted(b.parts)} for t, b in bundles.items()},
    }
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/manifest"
    )


def load_bundles(spark: SparkSession, path: str, targets: Sequence[str], features: Sequence[str]) -> dict[str, Bundle]:
    """Saved bundles; an error when targets or feature list are not the wanted ones."""
    manifest = json.loads(spark.read.text(f"{path}/manifest").first()["value"])
    if set(manifest["targets"]) != set(targets):
        raise ValueError("the saved models have other targets")
    if manifest["features"] != list(features):
        raise ValueError("the saved models have another feature list")
    return {
        target: Bundle(spec["kind"], {p: PipelineModel.load(f"{path}/{target}/{p}") for p in spec["parts"]})
        for target, spec in manifest["targets"].items()
    }


def train_or_reuse(train: DataFrame, kinds: Mapping[str, str], preprocessing: Preprocessing, path: str,
                   **options) -> tuple[dict[str, Bundle], str]:
    """Saved bundles when there are matching ones, else newly trained and saved."""
    spark = train.sparkSession
    features = preprocessing.columns()
    if _exists(spark, f"{path}/manifest"):
        return load_bundles(spark, path, list(kinds), features), "loaded"
    fits = [lambda t=t, kind=kind: FITTERS[kind](train, preprocessing, t, **options) for t, kind in kinds.items()]
    bundles = dict(zip(kinds, together(spark, fits)))
    save_bundles(spark, bundles, features, path)
    return load_bundles(spark, path, list(kinds), features), "trained"
