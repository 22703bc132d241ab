import pytest
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.plans import taxi, taxi_models
from tests.taxi_data import taxi_table


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("taxi") / "trips")
    taxi_table(spark).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def pdf(raw):
    frame = raw.toPandas()
    frame["minutes"] = (frame.tpep_dropoff_datetime - frame.tpep_pickup_datetime).dt.total_seconds() / 60
    return frame


def test_features_in_declared_order(raw, pdf):
    out = taxi.model_features(raw, ["source_row_id"])
    assert out.columns[1:] == taxi.MODEL_FEATURES
    got = out.toPandas().set_index("source_row_id").sort_index()
    base = pdf.set_index("source_row_id").sort_index()
    assert (got.trip_distance == base.trip_distance.clip(0, 100)).all()
    assert (got.trip_distance_was_capped == (base.trip_distance > 100)).all()
    assert (got.trip_distance_is_zero == (base.trip_distance == 0)).all()
    assert (got.trip_duration_was_adjusted == ((base.minutes < 1) | (base.minutes > 180))).all()
    assert (got.pickup_day_of_week == base.tpep_pickup_datetime.dt.dayofweek).all()


def test_export_and_summary(raw, pdf):
    out = taxi.export_table(raw)
    kept = pdf[pdf.total_amount > 0]
    assert out.count() == len(kept)
    assert not set(out.columns) & {*taxi.PARTS, taxi.PICKUP, "VendorID"}
    assert {"payment_type_0", "RatecodeID_99", "store_and_fwd_flag_Y"} <= set(out.columns)
    row = taxi.export_summary(raw).first()
    assert row["output_rows"] == len(kept) and row["nonpositive_total_rows"] == (pdf.total_amount <= 0).sum()
    assert row["passenger_nulls_filled_rows"] == kept.passenger_count.isna().sum()
    assert row["distance_capped_rows"] == (kept.trip_distance > 100).sum() and row["trip_distance_max"] == 5000.0
    valid = kept[(kept.trip_distance > 0) & (kept.trip_distance <= 100)]
    assert abs(row["spearman_valid"] - valid.trip_distance.rank().corr(valid.total_amount.rank())) < 1e-9
    assert abs(row["pearson_capped"] - pdf.trip_distance.clip(0, 100).corr(pdf.total_amount)) < 1e-9


def test_audit_matches_step_by_step_filtering(raw, pdf):
    trips, audit, summary = taxi.audited_trips(raw)
    rows = audit.orderBy("step_order").collect()
    left = pdf.drop(columns="source_row_id").drop_duplicates()
    assert rows[0]["removed_rows"] == len(pdf) - len(left) == 10
    speed = left.trip_distance / (left.minutes / 60)
    masks = [
        left.tpep_pickup_datetime.between("2026-05-01", "2026-06-01", inclusive="left"),
        left.minutes.between(1, 180), left.trip_distance.between(0.1, 100), speed <= 80, left.total_amount > 0,
        left.fare_amount >= 0, left.PULocationID.between(1, 265) & left.DOLocationID.between(1, 265),
    ]
    keep = masks[0]
    for row, mask in zip(rows[1:], masks):
        keep = keep & mask
        assert row["after_rows"] == keep.sum()
    assert trips.count() == rows[-1]["after_rows"] == summary.first()["valid_rows"]
    assert summary.first()["raw_rows"] == len(pdf)
    valid = left[keep]
    assert summary.first()["reclassified_rows"] == (valid.passenger_count == 0).sum()
    assert summary.first()["positive_label_rows"] == (valid.total_amount >= 30).sum()
    assert {"route_period_id", "pickup_hour_sin", "high_fare"} <= set(trips.columns)


def test_clean_trips_and_exclusions(raw, pdf):
    out = taxi.clean_trips(raw)
    limits = [(pdf[c].isna() | (pdf[c] <= v)) for c, v in taxi.PART_LIMITS.items()]
    keep = pdf.minutes.between(1, 120) & pdf.trip_distance.between(0.01, 100) & (pdf.payment_type != 6)
    for part in [*limits, *[(pdf[c].isna() | (pdf[c] >= 0)) for c in taxi.PARTS]]:
        keep &= part
    assert out.count() == len(pdf[keep].drop_duplicates(subset=taxi.SOURCE_COLUMNS))
    row = taxi.fare_exclusions(raw).first()
    assert row["voided_rows"] == (pdf.payment_type == 6).sum() and row["outside_period_rows"] == 0
    consistency = taxi.total_consistency(raw.where("total_amount > 0")).first()
    assert consistency["within_tolerance_ratio"] == 1.0
    q.require_reconciled(
        out.select("trip_time_minutes", "pickup_hour", "is_weekend"),
        taxi.clean_trips(raw.repartition(3)).select("trip_time_minutes", "pickup_hour", "is_weekend"),
    )


def test_other_preparations(raw, pdf):
    filled = taxi.filled_trips(raw)
    assert filled.count() == len(pdf) - 10 and filled.where("RatecodeID_was_missing").count() > 0
    assert taxi.analysis_trips(raw).where(F.col("surcharge_total").isNull()).isEmpty()
    assert taxi.pickup_features(raw).count() == len(pdf)
    complete = pdf.dropna(subset=taxi.PARTS)
    complete = complete[(complete.trip_distance > 0) & (complete.minutes > 0)]
    cap = complete.minutes.quantile(0.995)
    assert taxi.training_trips(raw).count() == (complete.minutes <= cap).sum()
    valid, targets = taxi.multi_output_trips(raw.withColumnRenamed("Airport_fee", "airport_fee"))
    assert "airport_fee" in targets and len(targets) == 9 and valid.count() > 0
    texts = raw.withColumns({
        taxi.PICKUP: F.when(F.col("source_row_id") < 100, "never").otherwise(F.col(taxi.PICKUP).cast("string")),
        "tip_amount": F.when(F.col("source_row_id") < 200, "n/a").otherwise(F.col("tip_amount").cast("string")),
    })
    read, _ = taxi.multi_output_trips(texts)
    assert read.where("source_row_id < 100").isEmpty()
    assert read.where("source_row_id < 200 AND tip_amount <> 0").isEmpty() and read.count() < valid.count()


def test_tables_and_statistics(raw):
    tables = {name: df.collect() for name, df in taxi.chart_tables(raw).items()}
    assert all(tables.values()) and len(tables["distance_histogram"]) == 60
    assert {r["column"] for r in tables["missing"]} == set(taxi.NULLABLE)
    statistics = taxi.month_statistics(raw)
    assert statistics["describe"].count() == 4 and statistics["card_vs_cash"].first()["significant"]


def test_final_run(raw):
    out = taxi_models.final_run(raw, trees=5)
    metrics, baseline = out["metrics"].first(), out["baseline"].first()
    assert metrics["mae"] < baseline["mae"] and abs(baseline["r2"]) < 0.05
    record = out["record"].first()
    assert record["data"]["test_rows"] == metrics["row_count"] and record["fare_bands"]
    with pytest.raises(ValueError, match="expected"):
        taxi.common_split(raw, check_rows=True)


def test_linear_and_route_runs(raw):
    out = taxi_models.pickup_time_run(raw)
    # Distances of 5000 miles stay on the test side, clipped to 100.
    assert out["metrics"].first()["median_ae"] < 3 and out["bands"].count() >= 2
    table = {r["experiment"]: r for r in taxi_models.route_experiments(raw, 5000).collect()}
    assert len(table) == 5 and table["zones"]["mae"] > 0


def test_per_part_bundles(raw, tmp_path):
    kinds = {"fare_amount": "regression", "tip_amount": "two_stage", "congestion_surcharge": "classification"}
    first, source = taxi_models.per_part_run(raw, str(tmp_path / "m"), kinds, trees=4, max_bins=32)
    again, loaded = taxi_models.per_part_run(raw, str(tmp_path / "m"), kinds, trees=4, max_bins=32)
    assert (source, loaded) == ("trained", "loaded")
    a = {r["target"]: r for r in first.collect()}
    b = {r["target"]: r for r in again.collect()}
    assert {k: r["mae"] for k, r in a.items()} == pytest.approx({k: r["mae"] for k, r in b.items()})
    assert a["fare_amount"]["mae"] < a["fare_amount"]["baseline_mae"]
    assert a["tip_amount"]["charge_f1"] > 0.9 and a["congestion_surcharge"]["accuracy"] > 0.9
    with pytest.raises(ValueError, match="targets"):
        taxi_models.per_part_run(raw, str(tmp_path / "m"), {"extra": "regression"})


def test_multi_output(raw):
    table = taxi_models.multi_output_cv(raw, folds=2, trees=2, depth=4, max_bins=32).collect()
    assert len(table) == 10 and all(r["folds"] == 2 for r in table)
    assert taxi_models.multi_output_run(raw, 2000, trees=2, depth=4, max_bins=32).first()["r2"] > 0.5
