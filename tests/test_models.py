import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerline.operators import models as m


@pytest.fixture(scope="module")
def sides(spark):
    rng = np.random.default_rng(11)
    n = 1500
    pdf = pd.DataFrame({
        "id": range(n), "a": rng.normal(5, 2, n), "b": rng.gamma(2, 3, n), "c": rng.choice(list("xyz"), n, p=[0.6, 0.3, 0.1]),
    })
    pdf["y"] = 3 + 2 * pdf.a - pdf.b + pdf.c.map({"x": 0.0, "y": 5.0, "z": -4.0}) + rng.normal(0, 0.5, n)
    df = spark.createDataFrame(pdf)
    return pdf[pdf.id < 1200], pdf[pdf.id >= 1200], df.where("id < 1200"), df.where("id >= 1200")


def design(train, rows):
    x = np.column_stack([(rows[c] - train[c].mean()) / train[c].std(ddof=0) for c in ("a", "b")])
    return np.column_stack([x, *[(rows.c == v).astype(float) for v in "xyz"]])


PREP = m.Preprocessing(numeric=["a", "b"], categorical=["c"])


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])


@pytest.mark.parametrize("alpha,intercept", [(10.0, True), (10.0, False), (300.0, True), (300.0, False)])
def test_ridge_matches_the_closed_form(sides, alpha, intercept):
    train, test, train_df, test_df = sides
    x, y = design(train, train), train.y.to_numpy()
    mx, my = (x.mean(axis=0), y.mean()) if intercept else (0.0, 0.0)
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    expected = (design(train, test) - mx) @ w + my
    model = m.fit_ridge(train_df, PREP, "y", alpha=alpha, fit_intercept=intercept)
    assert np.allclose(predictions(model, test_df), expected, atol=1e-6)


def test_least_squares_with_dependent_columns(sides, spark):
    train, test, train_df, test_df = sides
    x, y = design(train, train), train.y.to_numpy()
    w = np.linalg.lstsq(x - x.mean(axis=0), y - y.mean(), rcond=None)[0]
    expected = (design(train, test) - x.mean(axis=0)) @ w + y.mean()
    model = m.fit_linear(train_df, PREP, "y")
    assert np.allclose(predictions(model, test_df), expected, atol=1e-4)
    unknown = test_df.limit(0).unionByName(test_df.where("id = 1300").withColumn("c", F.lit("never")))
    row = test[test.id == 1300].assign(c="never")
    assert np.allclose(predictions(model, unknown), (design(train, row) - x.mean(axis=0)) @ w + y.mean(), atol=1e-4)


def test_log_target_is_restored(sides):
    train, test, train_df, test_df = sides
    shifted = [df.withColumn("y", F.exp(F.col("a") / 5)) for df in (train_df, test_df)]
    model = m.fit_ridge(shifted[0], m.Preprocessing(numeric=["a"]), "y", alpha=0.001, log_target=True)
    assert np.corrcoef(predictions(model, shifted[1]), np.exp(test.a / 5))[0, 1] > 0.99


def test_forbidden_features(sides):
    with pytest.raises(ValueError, match="leak"):
        m.Preprocessing(numeric=["a", "y"], forbidden=["y"]).stages()


def test_baselines(sides):
    train, _, train_df, test_df = sides
    for kind, value in (("mean", train.y.mean()), ("median", train.y.median())):
        out = m.baseline_constant(train_df, test_df, "y", kind)
        assert out.count() == test_df.count() and np.isclose(out.first()["prediction"], value)
    with pytest.raises(ValueError):
        m.baseline_constant(train_df, test_df, "y", "other")


def test_boosting_beats_the_baseline_and_survives_saving(sides, tmp_path):
    _, _, train_df, test_df = sides
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c"], scale=False, one_hot=False)
    model = m.fit_model(train_df, prep, m.gradient_boosting("y", trees=5, step=0.3, max_bins=32), "y")
    table = m.compare_models(train_df, test_df, "y", {
        "constant": lambda rows: m.ConstantModel(0.0), "boosted": lambda rows: model,
    })
    mae = {r["experiment"]: r["mae"] for r in table.collect()}
    assert mae["boosted"] < mae["constant"]
    row = m.model_roundtrip(model, test_df, ["id"], str(tmp_path / "m")).first()
    assert row["row_count"] == 300 and row["max_difference"] == 0.0


def test_unseen_amount_counts_as_wrong(sides):
    _, _, train_df, test_df = sides
    known = train_df.withColumn("fee", F.when(F.col("c") == "x", 0.5).otherwise(2.0))
    test = test_df.withColumn("fee", F.when(F.col("c") == "x", 0.5).when(F.col("c") == "y", 2.0).otherwise(9.0))
    prep = m.Preprocessing(numeric=["a"], categorical=["c"], scale=False, one_hot=False)
    bundle = m.fit_fixed_amount_target(known, prep, "fee", trees=10, max_bins=32)
    row = m.evaluate_bundles(known, test, {"fee": bundle}).first()
    share = test.where("fee < 9").count() / test.count()
    assert np.isclose(row["accuracy"], share) and row["kind"] == "classification"
    with pytest.raises(ValueError):
        m.Bundle("other", {}).predict(test, "p")


def test_models_leave_their_input_alone(sides):
    _, _, train_df, test_df = sides
    train, test = [df.withColumn("z", F.greatest(F.col("y") - 8, F.lit(0.0))) for df in (train_df, test_df)]
    prep = m.Preprocessing(numeric=["a", "b"], categorical=["c"], one_hot=False)
    bundles = {
        "y": m.fit_continuous_target(train, prep, "y", trees=3, max_bins=32),
        "z": m.fit_two_stage_target(train, prep, "z", trees=3, max_bins=32),
    }
    together = m.predict_bundles(bundles, test)
    assert together.columns == [*test.columns, "y_prediction", "z_prediction", "total_prediction"]
    assert together.select(test.columns).exceptAll(test).isEmpty()
    alone = bundles["z"].predict(test, "z_prediction")
    assert together.select("id", "z_prediction").exceptAll(alone.select("id", "z_prediction")).isEmpty()
    scored = m.fit_linear(train, PREP, "y").transform(test)
    assert scored.columns == [*test.columns, "prediction"]


def test_unknown_answers_are_left_out(sides):
    _, _, train_df, test_df = sides
    train = train_df.withColumn("t", F.when(F.col("id") % 2 == 0, F.col("y")))
    test = test_df.withColumn("t", F.when(F.col("id") % 3 == 0, F.col("y")))
    row = m.per_target_benchmark(train, test, ["t"], lambda rows, target: m.fit_ridge(rows, PREP, target)).first()
    assert row["train_rows"] == 600 and row["test_rows"] == 100
    with pytest.raises(ValueError):
        m.per_target_benchmark(train, test.where("t IS NULL"), ["t"], lambda rows, target: None)


def test_balanced_classifier(sides):
    _, _, train_df, test_df = sides
    train, test = [df.withColumn("h", (F.col("y") > 14).cast("int")) for df in (train_df, test_df)]
    plain = m.high_value_classifier(train, test, PREP, "h", balanced=False).first()
    balanced = m.high_value_classifier(train, test, PREP, "h").first()
    assert balanced["recall"] >= plain["recall"] and balanced["roc_auc"] > 0.9


def test_vocabulary_as_a_table_gives_the_same_vectors(spark, tmp_path):
    rows = [(i, float(i % 3), None if i % 5 == 0 else f"c{i % 4}", i % 7) for i in range(40)]
    schema = "id int, x double, c string, d int"
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([*rows[:9], (90, 2.5, "new", 99), (91, None, None, None)], schema)
    columns = {"numeric": ["x"], "categorical": ["c", "d"], "categorical_fill": None, "indicator": True}
    vectors = {}
    for limit in (0, 5, 100):  # all columns, one of them, none
        for hot in (True, False):
            fitted = m.assemble(train, m.Preprocessing(**columns, one_hot=hot, driver_categories=limit))
            if limit == 0:
                path = str(tmp_path / f"hot-{hot}")
                fitted.write().save(path)
                fitted = type(fitted).load(path)
            made = fitted.transform(test).select("id", m.FEATURES).collect()
            vectors[limit, hot] = sorted((r["id"], r[m.FEATURES].toArray().tolist()) for r in made)
    for hot in (True, False):
        assert vectors[0, hot] == vectors[5, hot] == vectors[100, hot]
    assert len(vectors[0, True][0][1]) == 2 + 4 + 7


def test_models_fit_on_a_vocabulary_table(spark):
    rows = [(f"c{i % 6}", float(i % 10), int(i % 6 > 2)) for i in range(120)]
    train = spark.createDataFrame(rows, "c string, x double, y int")
    scores = {}
    for limit in (0, 100):
        prep = m.Preprocessing(numeric=["x"], categorical=["c"], driver_categories=limit)
        trees = m.Preprocessing(numeric=["x"], categorical=["c"], one_hot=False, scale=False, driver_categories=limit)
        line = m.fit_model(train, prep, m.LogisticRegression(featuresCol=m.FEATURES, labelCol="y", regParam=0.1), "y")
        forest = m.fit_model(
            train, trees, m.RandomForestClassifier(featuresCol=m.FEATURES, labelCol="y", numTrees=5, seed=1), "y"
        )
        for model in (line, forest):
            out = model.transform(train)
            assert not [c for c in out.columns if c.endswith(("__in", "__index", "__hot"))]
            made = out.orderBy("c", "x").select(vector_to_array("probability")[1].alias("p")).collect()
            scores.setdefault(limit, []).append([r["p"] for r in made])
    for narrow, wide in zip(scores[100], scores[0], strict=True):
        assert narrow == pytest.approx(wide, abs=1e-9)


def test_a_million_categories(spark):
    n = 1_000_000
    rows = spark.range(n).select(F.format_string("k%07d", F.col("id")).alias("c"), F.lit(2.0).alias("x"))
    fitted = m.assemble(rows, m.Preprocessing(numeric=["x"], categorical=["c"], categorical_fill=None, numeric_fill=None, scale=False))
    made = fitted.transform(rows)
    assert len(made.schema[m.FEATURES].json()) < 10_000  # no names of categories in the plan
    own = made.select(F.substring("c", 2, 7).cast("int").alias("slot"), F.to_json(F.struct(m.FEATURES)).alias("j"))
    form = "struct<features: struct<type: int, size: int, indices: array<int>, values: array<double>>>"
    row = own.select("slot", F.from_json("j", form).features.alias("v")).agg(
        F.count("*"), F.min("v.size"), F.max("v.size"),
        F.sum((F.col("v.indices") == F.array(F.lit(0), F.col("slot") + 1)).cast("int")),
        F.sum((F.col("v.values") == F.array(F.lit(2.0), F.lit(1.0))).cast("int")),
    ).first()
    assert tuple(row) == (n, n + 1, n + 1, n, n)
