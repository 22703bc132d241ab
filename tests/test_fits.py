"""Fits on kept rows: how often they are dealt, joined and kept."""

from ledgerline.functions import sizing
from ledgerline.operators import models as m
from ledgerline.plans.catalog import learners


def test_only_small_inputs_are_dealt_again(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert "RepartitionByExpression" in sizing.spread_small(df)._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(sizing, "FIT_PARTITION_BYTES", 10)
    assert sizing.spread_small(df) is df


def test_assemble_fits_every_stage_on_kept_rows(spark, folder, monkeypatch):
    seen = []
    whole = m.assemble
    monkeypatch.setattr(m, "assemble", lambda rows, prep: seen.append(rows.storageLevel.useMemory) or whole(rows, prep))
    row = learners.assemble(spark, folder).first()
    assert seen == [True] and row["vector_size"] > 4


def test_rows_that_a_learner_keeps_itself_are_kept_once(spark, monkeypatch):
    rows = [(float(i % 10), float(i % 10 > 4)) for i in range(60)]
    train = spark.createDataFrame(rows, "x double, y double")
    levels = []
    for kind, learner in ((m.LogisticRegression, m.LogisticRegression(featuresCol=m.FEATURES, labelCol="y")),
                          (m.BoostedTrees, m.boosted_classifier("y", trees=2))):
        fit = kind.fit
        monkeypatch.setattr(kind, "fit", lambda self, df, fit=fit: levels.append(df.storageLevel.useMemory) or fit(self, df))
        m.fit_model(train, m.Preprocessing(numeric=["x"]), learner, "y")
    assert levels == [False, False]
