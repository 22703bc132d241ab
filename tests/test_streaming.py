"""Row-local work runs on a stream unchanged."""

from pyspark.sql import functions as F

from ledgerline.functions import expressions as x
from ledgerline.operators import features as feat
from ledgerline.operators.encoders import PopulationScaler
from ledgerline.session import scratch_path


def test_features_and_fitted_scaler_on_a_stream(spark, folder):
    batch = spark.read.parquet(f"{folder}/events.parquet")
    path = scratch_path(spark, "stream-in")
    batch.repartition(3).write.parquet(path)
    fitted = PopulationScaler(["value"]).fit(batch)

    def prepare(df):
        return fitted.transform(
            feat.time_features(df.where(F.col("value") > 1), "ts").withColumn("band", x.value_band("value", [30], ["low", "high"]))
        )

    out = scratch_path(spark, "stream-out")
    stream = prepare(spark.readStream.schema(batch.schema).parquet(path))
    query = (
        stream.writeStream.format("parquet").option("checkpointLocation", scratch_path(spark, "stream-log"))
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination(120)
    written, expected = spark.read.parquet(out), prepare(batch)
    assert written.count() == expected.count() and written.exceptAll(expected).isEmpty()
