"""Models on the trip split: fit on its training side, score every test row.

The target is the amount (price after discount, with tax); features are what it is made
of, plus codes. Ensembles run at the functions' default sizes. SQL checks their rows and
what must hold of them: they beat the constant, and they stay inside the bounds of the
training answers. Their exactness is checked where it can be stated: one tree on one code
column deep enough to isolate each code predicts the mean of its code, for all targets at
once, and one softmax round the Newton step of its code.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.functions.concurrent import together
from ledgerline.functions.expressions import threshold_label
from ledgerline.functions.quantiles import median_value
from ledgerline.operators import evaluation as ev
from ledgerline.operators import models as m
from ledgerline.operators.encoders import TargetEncoder
from ledgerline.operators.gram import cross_validate_ridge
from ledgerline.operators.results import best_by_metric
from ledgerline.operators.splits import random_split_hash
from ledgerline.plans.bindings import TRIP_HASH_SQL, TRIP_IDS, TRIP_SQL, trip
from ledgerline.plans.registry import query
from ledgerline.plans.taxi_models import MULTI_OUTPUT_FOREST, PART_FOREST
from ledgerline.session import scratch_path

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CODES = ["l_returnflag", "l_linestatus", "o_orderpriority"]
LINEAR = m.Preprocessing(numeric=NUMERIC, categorical=CODES, forbidden=["net", "tax", "amount"])
# Plain least squares scales and encodes, and fills nothing.
PLAIN = replace(LINEAR, numeric_fill=None, categorical_fill=None)
TREES = m.Preprocessing(
    numeric=NUMERIC, categorical=CODES, numeric_fill=0, categorical_fill="Unknown",
    scale=False, one_hot=False, forbidden=["net", "tax", "amount"],
)
# For the discount and the tax as targets: the price before and after them is known.
GIVEN = m.Preprocessing(
    numeric=["l_quantity", "l_extendedprice", "net"], categorical=CODES, scale=False, one_hot=False,
    forbidden=["l_discount", "l_tax"],
)

_SPLIT_SQL = TRIP_SQL + f""", trip_split AS (
  SELECT *, CASE WHEN {TRIP_HASH_SQL} % 10 < 2 THEN 'test' ELSE 'train' END AS split FROM trip),
train AS (SELECT * FROM trip_split WHERE split = 'train'), test AS (SELECT * FROM trip_split WHERE split = 'test')"""


def sides(spark, folder):
    rows = random_split_hash(trip(spark, folder), TRIP_IDS)
    return rows.where(F.col("split") == "train").drop("split"), rows.where(F.col("split") == "test").drop("split")


_HOLDS = "SELECT count(*) AS row_count, true AS beats_constant, true AS inside_bounds FROM test"


def _relations(train, test, model, target="amount"):
    """Rows, whether the absolute error is below the training median's, and whether every
    prediction lies between the training answers' ends, within their width."""
    ends = train.agg(F.min(target).alias("low"), F.max(target).alias("high"), F.avg(target).alias("mean")).first()
    margin = ends["high"] - ends["low"]
    error = F.avg(F.abs(F.col(m.PREDICTION) - F.col(target)))
    constant = F.avg(F.abs(F.lit(float(ends["mean"])) - F.col(target)))
    inside = F.col(m.PREDICTION).between(float(ends["low"] - margin), float(ends["high"] + margin))
    return model.transform(test).agg(
        F.count("*").alias("row_count"), (error < constant).alias("beats_constant"), F.bool_and(inside).alias("inside_bounds"),
    )


def _scored(model, test, target="amount"):
    with m.kept(model.transform(test).select(target, m.PREDICTION)) as scored:
        metrics = ev.regression_metrics(scored, target, m.PREDICTION)
        return test.sparkSession.createDataFrame(metrics.collect(), metrics.schema)


@query("assemble", f"""
WITH {_SPLIT_SQL}
SELECT count(*) AS row_count,
       4 + (SELECT count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) + count(DISTINCT o_orderpriority)
            FROM train) AS vector_size,
       7.0::DOUBLE AS mean_nonzero
FROM test
""", rounded="mean_nonzero")
def assemble(spark, folder):
    """Vector size and mean number of non-zero slots: four measures and one slot per code."""
    train, test = sides(spark, folder)
    with m.kept(train.select(*LINEAR.columns())) as rows:  # every stage is fitted on the same kept rows
        fitted = m.assemble(rows, LINEAR)
    values = fitted.transform(test).select(vector_to_array(m.FEATURES).alias("v"))
    return values.agg(
        F.count("*").alias("row_count"), F.max(F.size("v")).alias("vector_size"),
        F.avg(F.size(F.filter("v", lambda e: e != 0.0))).alias("mean_nonzero"),
    )


@query("linear_regression", f"""
WITH {_SPLIT_SQL}, line AS (SELECT regr_slope(amount, l_extendedprice) AS a, regr_intercept(amount, l_extendedprice) AS b FROM train)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a * l_extendedprice + b AS prediction FROM test, line
""", rounded="prediction", digits=2)
def linear_regression(spark, folder):
    train, test = sides(spark, folder)
    one = m.Preprocessing(numeric=["l_extendedprice"], numeric_fill=None)
    return m.fit_linear(train, one, "amount").transform(test).select(*TRIP_IDS, "prediction")


@query("ridge", f"""
WITH {_SPLIT_SQL},
fitted AS (SELECT avg(l_extendedprice) AS xm, stddev_pop(l_extendedprice) AS xs, avg(amount) AS ym,
                  count(*) * covar_pop(amount, l_extendedprice) / stddev_pop(l_extendedprice) / (count(*) + 100.0) AS slope FROM train)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ym + slope * (l_extendedprice - xm) / xs AS prediction
FROM test, fitted
""", rounded="prediction", digits=2)
def ridge(spark, folder):
    train, test = sides(spark, folder)
    one = m.Preprocessing(numeric=["l_extendedprice"])
    return m.fit_ridge(train, one, "amount", alpha=100.0).transform(test).select(*TRIP_IDS, "prediction")


@query("linear_regression_codes", f"WITH {_SPLIT_SQL} {_HOLDS}")
def linear_regression_codes(spark, folder):
    train, test = sides(spark, folder)
    return _relations(train, test, m.fit_linear(train, PLAIN, "amount"))


@query("ridge_log_target", f"""
WITH {_SPLIT_SQL},
fitted AS (SELECT avg(l_extendedprice) AS xm, stddev_pop(l_extendedprice) AS xs, avg(ln(1 + amount)) AS ym,
                  count(*) * covar_pop(ln(1 + amount), l_extendedprice) / stddev_pop(l_extendedprice)
                    / (count(*) + 10.0) AS slope FROM train),
scored AS (SELECT amount AS y, exp(ym + slope * (l_extendedprice - xm) / xs) - 1 AS p FROM test, fitted)
SELECT count(*) AS row_count, avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse,
       quantile_cont(abs(p - y), 0.5) AS median_ae, 1 - avg((p - y) * (p - y)) / var_pop(y) AS r2 FROM scored
""", rounded="mae rmse median_ae r2", digits=4)
def ridge_log_target(spark, folder):
    train, test = sides(spark, folder)
    one = m.Preprocessing(numeric=["l_extendedprice"])
    return _scored(m.fit_ridge(train, one, "amount", alpha=10.0, log_target=True), test)


@query("gradient_boosting", f"WITH {_SPLIT_SQL} {_HOLDS}")
def gradient_boosting(spark, folder):
    train, test = sides(spark, folder)
    return _relations(train, test, m.fit_model(train, TREES, m.gradient_boosting("amount"), "amount"))


_CODE_MEAN_SQL = f"""
WITH {_SPLIT_SQL}, means AS (SELECT o_orderpriority, avg(amount) AS prediction FROM train GROUP BY o_orderpriority)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, prediction FROM test JOIN means USING (o_orderpriority)"""
ONE_CODE = m.Preprocessing(categorical=["o_orderpriority"], categorical_fill=None, scale=False, one_hot=False)


@query("one_tree_boosting", _CODE_MEAN_SQL, rounded="prediction", digits=4)
def one_tree_boosting(spark, folder):
    """A single boosting step of full size on one code column: the training mean of each code."""
    train, test = sides(spark, folder)
    model = m.fit_model(train, ONE_CODE, m.gradient_boosting("amount", trees=1, step=1.0), "amount")
    return model.transform(test).select(*TRIP_IDS, m.PREDICTION)


def _majority_sql(answer: str) -> str:
    return f"""
WITH {_SPLIT_SQL}, counted AS (SELECT o_orderpriority, {answer} AS answer, count(*) AS n FROM train GROUP BY ALL),
best AS (SELECT o_orderpriority, arg_max(answer, n) AS answer FROM counted GROUP BY o_orderpriority)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(best.answer AS DOUBLE) AS prediction
FROM test JOIN best USING (o_orderpriority)"""


_BAND_SQL = "CASE WHEN amount < 30000 THEN 0 WHEN amount < 60000 THEN 1 ELSE 2 END"


def _with_band(rows):
    return rows.withColumn("band", F.when(F.col("amount") < 30_000, 0.0).when(F.col("amount") < 60_000, 1.0).otherwise(2.0))


@query("majority_multiclass", _majority_sql(_BAND_SQL))
def majority_multiclass(spark, folder):
    """One boosting step per band on one code column: the most frequent band of each code."""
    train, test = [_with_band(s) for s in sides(spark, folder)]
    model = m.fit_softmax_trees(train, ONE_CODE, "band", rounds=1, step=1.0, min_leaf=1)
    return model.transform(test).select(*TRIP_IDS, m.PREDICTION)


def _classified(train, test, model, label):
    """Rows, and whether more of them are right than with the most frequent training class."""
    top = train.groupBy(label).count().orderBy(F.desc("count"), label).first()[label]
    right = F.avg((F.col(m.PREDICTION) == F.col(label)).cast("double"))
    return model.transform(test).agg(
        F.count("*").alias("row_count"), (right > F.avg((F.col(label) == top).cast("double"))).alias("beats_constant")
    )


_BETTER = "SELECT count(*) AS row_count, true AS beats_constant FROM test"


@query("boosted_classifier", f"WITH {_SPLIT_SQL} {_BETTER}")
def boosted_classifier(spark, folder):
    train, test = [s.withColumn("high", threshold_label("amount", 50_000).cast("double")) for s in sides(spark, folder)]
    return _classified(train, test, m.fit_model(train, TREES, m.boosted_classifier("high"), "high"), "high")


@query("multiclass_classifier", f"WITH {_SPLIT_SQL} {_BETTER}")
def multiclass_classifier(spark, folder):
    train, test = [_with_band(s) for s in sides(spark, folder)]
    return _classified(train, test, m.fit_softmax_trees(train, TREES, "band"), "band")


def _total_holds(train, test, predicted, pairs, total):
    """Per target and for the sum: rows, and whether it beats the training means."""
    means = train.agg(*[F.avg(t).alias(t) for t in pairs]).first().asDict()
    means[total] = sum(means.values())
    pairs = {**pairs, total: f"{total}_prediction"}
    answers = predicted.withColumn(total, sum((F.col(t) for t in means if t != total), F.lit(0.0))).withColumn(
        f"{total}_prediction", sum((F.col(p) for t, p in pairs.items() if t != total), F.lit(0.0)))
    checks = [F.struct(
        F.lit(t).alias("target"), F.count("*").alias("row_count"),
        (F.avg(F.abs(F.col(p) - F.col(t))) < F.avg(F.abs(F.lit(float(means[t])) - F.col(t)))).alias("beats_constant"),
    ) for t, p in pairs.items()]
    return answers.agg(F.array(*checks).alias("r")).select(F.inline("r"))


_PARTS_SQL = f"""
WITH {_SPLIT_SQL} SELECT target, (SELECT count(*) FROM test) AS row_count, true AS beats_constant
FROM (VALUES ('net'), ('tax'), ('total')) t(target)"""


@query("random_forest_multi", _PARTS_SQL)
def random_forest_multi(spark, folder):
    train, test = sides(spark, folder)
    model = m.fit_forest_multi(train, TREES, ["net", "tax"], **PART_FOREST)
    return _total_holds(train, test, model.transform(test), {"net": "net_prediction", "tax": "tax_prediction"}, "total")


@query("one_tree_forest", f"""
WITH {_SPLIT_SQL}, means AS (SELECT o_orderpriority, avg(net) AS net_prediction, avg(tax) AS tax_prediction FROM train GROUP BY o_orderpriority)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, net_prediction, tax_prediction FROM test JOIN means USING (o_orderpriority)
""", rounded="net_prediction tax_prediction", digits=4)
def one_tree_forest(spark, folder):
    """A single tree on one code column, without drawing: the training means of both targets per code."""
    train, test = sides(spark, folder)
    model = m.fit_forest_multi(train, ONE_CODE, ["net", "tax"], trees=1, depth=5, min_leaf=1, draw=False)
    return model.transform(test).select(*TRIP_IDS, "net_prediction", "tax_prediction")


@query("one_round_softmax", f"""
WITH {_SPLIT_SQL}, banded AS (SELECT o_orderpriority AS code, {_BAND_SQL} AS band FROM train),
shares AS (SELECT k, count(*) FILTER (WHERE band = k) * 1.0 / count(*) AS share FROM banded, range(3) r(k) GROUP BY k),
leaves AS (SELECT code, k, ln(share) + (count(*) FILTER (WHERE band = k) - share * count(*)) / (1.5 * count(*) * share * (1 - share)) AS score
           FROM banded, shares GROUP BY code, k, share),
chances AS (SELECT code, k, exp(score) / sum(exp(score)) OVER (PARTITION BY code) AS p FROM leaves)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, max(p) FILTER (WHERE k = 0) AS low, max(p) FILTER (WHERE k = 1) AS middle,
       max(p) FILTER (WHERE k = 2) AS high FROM test JOIN chances ON code = o_orderpriority GROUP BY ALL
""", rounded="low middle high", digits=6)
def one_round_softmax(spark, folder):
    """One round of full step on one code column: each band's log share plus the Newton step of the code."""
    train, test = [_with_band(s) for s in sides(spark, folder)]
    model = m.fit_softmax_trees(train, ONE_CODE, "band", rounds=1, step=1.0, min_leaf=1)
    *stages, trees, _ = model.stages
    vectors = PipelineModel(stages).transform(test)
    p = trees.probability(vectors)
    return vectors.withColumn("p", p).select(*TRIP_IDS, *[F.col("p")[i].alias(c) for i, c in enumerate(("low", "middle", "high"))])


def _bundle_holds(spark, folder, kind, target, preparation=GIVEN, **options):
    """Rows, and whether the error is below that of the training median or mode."""
    train, test = sides(spark, folder)
    bundle = m.FITTERS[kind](train, preparation, target, **options)
    scores = m.evaluate_bundles(train, test, {target: bundle})
    better = F.col("accuracy") > F.col("baseline_accuracy") if kind == "classification" else F.col("mae") < F.col("baseline_mae")
    return scores.select("target", "kind", "row_count", better.alias("beats_constant"))


def _bundle_sql(kind: str, target: str) -> str:
    return f"WITH {_SPLIT_SQL} SELECT '{target}' AS target, '{kind}' AS kind, count(*) AS row_count, true AS beats_constant FROM test"


@query("continuous_target", _bundle_sql("regression", "net"))
def continuous_target(spark, folder):
    """The price after discount, from price and discount."""
    return _bundle_holds(spark, folder, "regression", "net", TREES)


@query("two_stage_target", _bundle_sql("two_stage", "l_discount"))
def two_stage_target(spark, folder):
    return _bundle_holds(spark, folder, "two_stage", "l_discount")


@query("fixed_amount_target", _bundle_sql("classification", "l_discount"))
def fixed_amount_target(spark, folder):
    """Eleven amounts, 40 rounds; ``multiclass_classifier`` runs the full 200."""
    return _bundle_holds(spark, folder, "classification", "l_discount", trees=40)


@query("predict_bundle", f"""
WITH {_SPLIT_SQL} SELECT count(*) AS row_count, 0 AS negative_rows, 0 AS rows_off_the_sum, 0 AS unknown_amounts FROM test
""")
def predict_bundle(spark, folder):
    """One bundle of each kind on every test row: no negative amount, the total is the sum,
    and a fixed amount is always one that training had."""
    train, test = sides(spark, folder)
    with m.kept(train.select(*dict.fromkeys([*TREES.columns(), *GIVEN.columns(), "tax"]))) as rows:  # joined once for all fits
        known = [r[0] for r in rows.select("l_tax").distinct().collect()]
        bundles = dict(zip(("tax", "l_discount", "l_tax"), together(spark, [
            lambda: m.fit_continuous_target(rows, TREES, "tax", trees=20),
            lambda: m.fit_two_stage_target(rows, GIVEN, "l_discount", trees=20),
            lambda: m.fit_fixed_amount_target(rows, GIVEN, "l_tax", trees=20),
        ])))
    names = [f"{t}_prediction" for t in bundles]
    off = F.abs(F.col("total_prediction") - sum((F.col(c) for c in names), F.lit(0.0))) > 1e-9
    return m.predict_bundles(bundles, test).agg(
        F.count("*").alias("row_count"), F.count_if(F.least(*names) < 0).cast("int").alias("negative_rows"),
        F.count_if(off).cast("int").alias("rows_off_the_sum"),
        F.count_if(~F.col("l_tax_prediction").isin(known)).cast("int").alias("unknown_amounts"),
    )


def _target_sql(target: str) -> str:
    return f"""
SELECT '{target}' AS target, (SELECT count(*) FROM train) AS train_rows, count(*) AS test_rows, avg(y) AS test_mean,
       avg(CASE WHEN y <> 0 THEN 1.0 ELSE 0.0 END) AS test_nonzero_rate, avg(abs(p - y)) AS mae,
       sqrt(avg((p - y) * (p - y))) AS rmse, quantile_cont(abs(p - y), 0.5) AS median_ae,
       1 - avg((p - y) * (p - y)) / var_pop(y) AS r2
FROM (SELECT {target} AS y, a + b * l_extendedprice AS p FROM test, (
  SELECT regr_intercept({target}, l_extendedprice) AS a, regr_slope({target}, l_extendedprice) AS b FROM train) f) s"""


@query("per_target_benchmark", f"WITH {_SPLIT_SQL} " + " UNION ALL ".join(_target_sql(t) for t in ("net", "tax")),
       rounded="test_mean test_nonzero_rate mae rmse median_ae r2", digits=4)
def per_target_benchmark(spark, folder):
    train, test = [s.select("l_extendedprice", "net", "tax") for s in sides(spark, folder)]
    one = m.Preprocessing(numeric=["l_extendedprice"])
    table = m.per_target_benchmark(train, test, ["net", "tax"], lambda rows, t: m.fit_linear(rows, one, t))
    return table.drop("fit_seconds")


def _fold_sql(target: str, predicted: str) -> str:
    e = f"({predicted} - {target})"
    return (
        f"SELECT '{target}' AS target, k, count(*) AS n, 1 - avg({e} * {e}) / var_pop({target}) AS r2, "
        f"avg(abs({e})) AS mae, sqrt(avg({e} * {e})) AS rmse FROM scored GROUP BY k"
    )


@query("cross_validate_linear", f"""
WITH {TRIP_SQL}, folded AS (SELECT *, net + tax AS total, {TRIP_HASH_SQL} % 5 AS fold FROM trip),
fitted AS (SELECT k, regr_intercept(net, l_extendedprice) AS na, regr_slope(net, l_extendedprice) AS nb,
                  regr_intercept(tax, l_extendedprice) AS ta, regr_slope(tax, l_extendedprice) AS tb
           FROM folded, range(5) r(k) WHERE fold <> k GROUP BY k),
scored AS (SELECT k, net, tax, total, na + nb * l_extendedprice AS pn, ta + tb * l_extendedprice AS pt
           FROM folded JOIN fitted ON fold = k),
per_fold AS ({_fold_sql("net", "pn")} UNION ALL {_fold_sql("tax", "pt")} UNION ALL {_fold_sql("total", "(pn + pt)")})
SELECT target, count(*) AS folds, CAST(sum(n) AS BIGINT) AS row_count, avg(r2) AS r2_mean, stddev_pop(r2) AS r2_std,
       avg(mae) AS mae_mean, avg(rmse) AS rmse_mean FROM per_fold GROUP BY target
""", rounded="r2_mean r2_std mae_mean rmse_mean", digits=4)
def cross_validate_linear(spark, folder):
    """Least squares for every fold and target from one table of sums."""
    one = m.Preprocessing(numeric=["l_extendedprice"])
    rows = trip(spark, folder).select(*TRIP_IDS, "l_extendedprice", "net", "tax")
    return cross_validate_ridge(rows, TRIP_IDS, ["net", "tax"], one, alpha=None, folds=5)


@query("cross_validate", f"""
WITH {TRIP_SQL} SELECT target, 5 AS folds, (SELECT count(*) FROM trip) AS row_count, true AS beats_constant
FROM (VALUES ('net'), ('tax'), ('total')) t(target)
""")
def cross_validate(spark, folder):
    """Five folds of a forest per target; a mean R2 above 0 beats each fold's mean."""
    rows = trip(spark, folder).select(*TRIP_IDS, *NUMERIC, *CODES, "net", "tax")
    scores = m.cross_validate(
        rows, TRIP_IDS, ["net", "tax"],
        lambda part: m.fit_forest_multi(part, TREES, ["net", "tax"], **MULTI_OUTPUT_FOREST), folds=5,
    )
    return scores.select("target", F.col("folds").cast("int").alias("folds"), "row_count", (F.col("r2_mean") > 0).alias("beats_constant"))


def _compared(spark, folder):
    train, test = [s.select(*TRIP_IDS, *NUMERIC, *CODES, "amount") for s in sides(spark, folder)]
    encoder = TargetEncoder(["l_suppkey"], "amount")
    with_stats = m.Preprocessing(numeric=[*NUMERIC, "l_suppkey_mean"], categorical=CODES)

    def route_statistics(rows):
        encoded = encoder.fit_transform_crossfit(rows, TRIP_IDS)
        fitted = m.fit_ridge(encoded, with_stats, "amount")
        return PipelineModel([encoder.fit(rows), fitted])

    return m.compare_models(train, test, "amount", {
        "constant_median": lambda rows: m.ConstantModel(median_value(rows, "amount")),
        "ridge_base": lambda rows: m.fit_ridge(rows, LINEAR, "amount"),
        "ridge_log": lambda rows: m.fit_ridge(rows, LINEAR, "amount", log_target=True),
        "ridge_no_intercept": lambda rows: m.fit_ridge(rows, LINEAR, "amount", fit_intercept=False),
        "ridge_group_statistics": route_statistics,
    })


_VARIANTS = ["constant_median", "ridge_base", "ridge_log", "ridge_no_intercept", "ridge_group_statistics"]


@query("compare_models", f"""
WITH {_SPLIT_SQL}, middle AS (SELECT quantile_cont(amount, 0.5) AS p FROM train)
SELECT experiment, count(*) AS row_count,
       CASE WHEN experiment = 'constant_median' THEN avg(abs(p - amount)) END AS constant_mae,
       experiment <> 'constant_median' AS beats_constant
FROM test, middle, (VALUES {", ".join(f"('{v}')" for v in _VARIANTS)}) t(experiment) GROUP BY experiment
""", rounded="constant_mae", digits=4)
def compare_models(spark, folder):
    """Every variant on the same rows; the constant's error exactly, the others below it."""
    scores = _compared(spark, folder)
    constant = scores.where("experiment = 'constant_median'").first()["mae"]
    is_constant = F.col("experiment") == "constant_median"
    return scores.select("experiment", "row_count", F.when(is_constant, F.col("mae")).alias("constant_mae"),
                         (F.col("mae") < constant).alias("beats_constant"))


@query("best_model", "SELECT 1 AS chosen, true AS smallest_error, false AS is_the_constant")
def best_model(spark, folder):
    """One variant is chosen; no other but the excluded constant has a smaller error."""
    scores = _compared(spark, folder)
    best = best_by_metric(scores, "experiment", "mae", ["constant_median"])
    least = scores.where("experiment <> 'constant_median'").agg(F.min("mae")).first()[0]
    return best.agg(
        F.count("*").cast("int").alias("chosen"), F.bool_and(F.col("mae") == least).alias("smallest_error"),
        F.bool_or(F.col("experiment") == "constant_median").alias("is_the_constant"),
    )


@query("high_value_classifier", f"""
WITH {_SPLIT_SQL} SELECT count(*) AS row_count, true AS better_than_chance, true AS f1_fits FROM test
""")
def high_value_classifier(spark, folder):
    train, test = [s.withColumn("high", threshold_label("amount", 80_000)) for s in sides(spark, folder)]
    scores = m.high_value_classifier(train, test, LINEAR, "high")
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
    return scores.select("row_count", (F.col("roc_auc") > 0.9).alias("better_than_chance"),
                         (F.abs(f1 - F.col("f1")) < 1e-9).alias("f1_fits"))


@query("compare_predictions", f"""
WITH {_SPLIT_SQL},
fitted AS (SELECT avg(l_extendedprice) AS xm, regr_slope(amount, l_extendedprice) AS b, count(*) AS n FROM train)
SELECT count(*) AS row_count, max(abs(b * (l_extendedprice - xm) * (1 - n / (n + 1000.0)))) AS max_difference
FROM test, fitted
""", rounded="max_difference", digits=3)
def compare_predictions(spark, folder):
    train, test = sides(spark, folder)
    one = m.Preprocessing(numeric=["l_extendedprice"])
    plain = m.fit_linear(train, one, "amount").transform(test)
    shrunk = m.fit_ridge(train, one, "amount", alpha=1000.0).transform(test)
    return m.compare_predictions(plain, shrunk, TRIP_IDS)


@query("model_roundtrip", f"WITH {_SPLIT_SQL} SELECT count(*) AS row_count, 0.0::DOUBLE AS max_difference FROM test")
def model_roundtrip(spark, folder):
    train, test = sides(spark, folder)
    model = m.fit_model(train, TREES, m.gradient_boosting("amount", trees=20), "amount")
    return m.model_roundtrip(model, test, TRIP_IDS, scratch_path(spark, "model"))


@query("model_reuse", f"""
WITH {_SPLIT_SQL} SELECT target, (SELECT count(*) FROM test) AS row_count, 'trained' AS first_source, 'loaded' AS second_source
FROM (VALUES ('net'), ('tax'), ('amount')) t(target)
""")
def model_reuse(spark, folder):
    """The second call finds the saved bundles and only evaluates them."""
    train, test = sides(spark, folder)
    path = scratch_path(spark, "bundles")
    kinds = {"net": "regression", "tax": "regression"}
    _, first = m.train_or_reuse(train, kinds, TREES, path, trees=10)
    bundles, second = m.train_or_reuse(train, kinds, TREES, path, trees=10)
    return m.evaluate_bundles(train, test, bundles, "amount").select(
        "target", "row_count", F.lit(first).alias("first_source"), F.lit(second).alias("second_source")
    )
