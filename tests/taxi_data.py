"""A small taxi-shaped table with known defects, made by Spark from row numbers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def taxi_table(spark: SparkSession, rows: int = 6000) -> DataFrame:
    def noise(seed, mod):
        return F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(mod))

    start = F.expr("timestamp_ntz'2026-05-01' + make_dt_interval(0, 0, 0, CAST(pmod(xxhash64(id, 1), 2678400) AS DOUBLE))")
    base = spark.range(rows, numPartitions=4).select(
        "id",
        start.alias("tpep_pickup_datetime"),
        (noise(2, 1500) / 100.0 + 0.2).alias("trip_distance"),
        (noise(3, 6) + 1).cast("double").alias("passenger_count"),
        (noise(4, 2) + 1).cast("int").alias("VendorID"),
        F.when(noise(5, 20) == 0, 2.0).otherwise(1.0).alias("RatecodeID"),
        F.when(noise(6, 50) == 0, "Y ").otherwise("N").alias("store_and_fwd_flag"),
        (noise(7, 20) + 120).cast("int").alias("PULocationID"),
        (noise(8, 20) + 120).cast("int").alias("DOLocationID"),
        (noise(9, 2) + 1).cast("int").alias("payment_type"),
        noise(10, 300).alias("slack"),
    )
    d = F.col("trip_distance")
    parts = {
        "fare_amount": F.round(3.0 + 2.5 * d, 2),
        "extra": F.when(F.hour("tpep_pickup_datetime") >= 16, 2.5).otherwise(0.0),
        "mta_tax": F.lit(0.5),
        "tip_amount": F.when(F.col("payment_type") == 1, F.round(0.6 + 0.4 * d, 2)).otherwise(0.0),
        "tolls_amount": F.when(d > 12, 6.94).otherwise(0.0),
        "improvement_surcharge": F.lit(1.0),
        "congestion_surcharge": F.when(F.col("PULocationID") < 130, 2.5).otherwise(0.0),
        "Airport_fee": F.when(F.col("PULocationID") == 132, 2.0).otherwise(0.0),
        "cbd_congestion_fee": F.when(F.col("DOLocationID") < 130, 0.75).otherwise(0.0),
    }
    seconds = (180 + d * 150 + F.col("slack")).cast("int")
    whole = base.withColumns(parts).withColumn("seconds", seconds)
    total = sum(F.col(c) for c in parts)
    whole = whole.withColumn("total_amount", F.round(total, 2)).withColumn(
        "tpep_dropoff_datetime", F.expr("tpep_pickup_datetime + make_dt_interval(0, 0, 0, CAST(seconds AS DOUBLE))")
    )
    i = F.col("id")
    dirty = whole.withColumns({
        # Rows of one collection way lack five columns together.
        "passenger_count": F.when(i % 5 != 0, F.when(i % 101 == 0, 0.0).otherwise(F.col("passenger_count"))),
        "RatecodeID": F.when(i % 5 != 0, F.col("RatecodeID")),
        "store_and_fwd_flag": F.when(i % 5 != 0, F.col("store_and_fwd_flag")),
        "congestion_surcharge": F.when(i % 5 != 0, F.col("congestion_surcharge")),
        "Airport_fee": F.when(i % 5 != 0, F.col("Airport_fee")),
        "payment_type": F.when(i % 5 == 0, 0).when(i % 997 == 1, 6).otherwise(F.col("payment_type")),
        "trip_distance": F.when(i % 301 == 7, 5000.0).when(i % 307 == 9, 0.0).otherwise(F.col("trip_distance")),
        "total_amount": F.when(i % 211 == 3, -F.col("total_amount")).otherwise(F.col("total_amount")),
        "fare_amount": F.when(i % 211 == 3, -F.col("fare_amount")).otherwise(F.col("fare_amount")),
        "tpep_dropoff_datetime": F.when(i % 401 == 11, F.col("tpep_pickup_datetime")).otherwise(
            F.col("tpep_dropoff_datetime")),
    })
    copies = dirty.where(F.col("id") < 10).withColumn("id", F.col("id") + rows)
    return dirty.unionByName(copies).withColumnRenamed("id", "source_row_id").drop("slack", "seconds")
