"""Model flows on taxi trip records: fit on training trips, score every test trip."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ledgerline.functions.quantiles import median_value
from ledgerline.operators import evaluation as ev
from ledgerline.operators import models as m
from ledgerline.operators import splits as sp
from ledgerline.operators.encoders import TargetEncoder
from ledgerline.operators.features import time_features
from ledgerline.operators.quality import dedup_keep_first
from ledgerline.operators.results import metrics_record
from ledgerline.plans import taxi

FORBIDDEN = [*taxi.PARTS, taxi.TOTAL]

# The sizes of the two forests.
PART_FOREST = {"trees": 100, "depth": 15, "min_leaf": 1}
MULTI_OUTPUT_FOREST = {"trees": 80, "depth": 20, "min_leaf": 50}

# Which kind of model each part gets.
PART_KINDS = {
    "fare_amount": "regression", "extra": "regression",
    "tip_amount": "two_stage", "tolls_amount": "two_stage",
    "mta_tax": "classification", "improvement_surcharge": "classification",
    "congestion_surcharge": "classification", "Airport_fee": "classification",
    "cbd_congestion_fee": "classification",
}

FINAL = m.Preprocessing(
    numeric=taxi.NUMERIC_FEATURES, categorical=[*taxi.CODE_FEATURES, "store_and_fwd_flag"],
    numeric_fill=0, scale=False, one_hot=False, forbidden=FORBIDDEN,
    categorical_fill={**dict.fromkeys(taxi.CODE_FEATURES, taxi.UNKNOWN_RATE_CODE), "store_and_fwd_flag": "Unknown"},
)
PICKUP_TIME = m.Preprocessing(
    numeric=["trip_distance", "passenger_count"], categorical=["pickup_hour", "pickup_weekday", "RatecodeID"],
    passthrough=["is_airport", "is_weekend"], numeric_fill=None, categorical_fill=None, forbidden=FORBIDDEN,
)
# The columns of each variant.
_CYCLIC = [
    "passenger_count", "pickup_hour_sin", "pickup_hour_cos", "pickup_dayofweek_sin", "pickup_dayofweek_cos",
    "is_weekend",
]
ROUTE_BASE = m.Preprocessing(
    numeric=_CYCLIC, categorical=["VendorID", "PULocationID", "DOLocationID"], forbidden=FORBIDDEN, indicator=True,
)
ROUTE_MATCH = m.Preprocessing(
    numeric=_CYCLIC, categorical=["VendorID", "PULocationID", "DOLocationID", "route_id", "pickup_period"],
    forbidden=FORBIDDEN, min_frequency=20, indicator=True,
)
ROUTE_STATISTICS = m.Preprocessing(
    numeric=[*_CYCLIC, "route_id_mean", "route_period_id_mean"],
    categorical=["VendorID", "PULocationID", "DOLocationID", "pickup_period"], forbidden=FORBIDDEN, indicator=True,
)
PER_PART = m.Preprocessing(
    numeric=["passenger_count", "trip_distance", "trip_time_minutes", "pickup_hour", "pickup_weekday"],
    categorical=["VendorID", "RatecodeID", "PULocationID", "DOLocationID", "payment_type", "is_weekend"],
    one_hot=False, ordinal=True, indicator=True, forbidden=FORBIDDEN,
)
MULTI_OUTPUT = m.Preprocessing(
    numeric=["trip_distance", "trip_duration_min", "passenger_count", "pickup_hour", "pickup_weekday"],
    categorical=["VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag"],
    scale=False, one_hot=False, forbidden=FORBIDDEN,
)


def final_run(
    raw: DataFrame, trees: int = 100, check_rows: bool = False, path: str | None = None
) -> dict[str, DataFrame | PipelineModel]:
    """Split, deduplicated training side, boosted model, baseline, bands and record.

    With a ``path`` the model is saved there, loaded again, and both predict the test trips.
    """
    train_raw, test_raw = taxi.common_split(raw, check_rows)
    train = taxi.model_features(dedup_keep_first(train_raw, taxi.ROW_ID), [taxi.ROW_ID, taxi.TOTAL])
    test = taxi.model_features(test_raw, [taxi.ROW_ID, taxi.TOTAL])
    model = m.fit_model(train, FINAL, m.gradient_boosting(taxi.TOTAL, trees), taxi.TOTAL)
    scored = model.transform(test).select(taxi.ROW_ID, taxi.TOTAL, m.PREDICTION)
    with m.kept(m.baseline_constant(train, scored, taxi.TOTAL, "mean", "baseline")) as rows:
        ev.require_scorable(rows, taxi.TOTAL, m.PREDICTION)
        metrics = _fixed(ev.regression_metrics(rows, taxi.TOTAL, m.PREDICTION))
        baseline = _fixed(ev.regression_metrics(rows, taxi.TOTAL, "baseline"))
        bands = _fixed(ev.band_metrics(rows, taxi.TOTAL, m.PREDICTION))
    record = metrics_record(
        metrics, bands, "final_boosting_v1", "final", taxi.TOTAL, train.count(),
        metrics.first()["row_count"], taxi.SPLIT_ID, True,
    )
    result = {"model": model, "metrics": metrics, "baseline": baseline, "bands": bands, "record": record}
    if path is not None:
        result["reload"] = _fixed(m.model_roundtrip(model, test, [taxi.ROW_ID], path))
    return result


def _fixed(result: DataFrame) -> DataFrame:
    """A small result table, evaluated now."""
    return result.sparkSession.createDataFrame(result.collect(), result.schema)


def pickup_time_run(raw: DataFrame) -> dict[str, DataFrame]:
    """Linear model on features known at pickup; only training trips are filtered."""
    train_raw, test_raw = taxi.common_split(raw)
    train, test = taxi.pickup_features(train_raw.where(taxi.plausible())), taxi.pickup_features(test_raw)
    model = m.fit_linear(train, PICKUP_TIME, taxi.TOTAL)
    with m.kept(model.transform(test).select(taxi.TOTAL, m.PREDICTION)) as scored:
        return {
            "metrics": _fixed(ev.regression_metrics(scored, taxi.TOTAL, m.PREDICTION)),
            "bands": _fixed(ev.band_metrics(scored, taxi.TOTAL, m.PREDICTION)),
        }


def pickup_time_parts(raw: DataFrame) -> DataFrame:
    """The same model for each part; the airport fee does not see the airport flag."""
    train_raw, test_raw = taxi.common_split(raw)
    train, test = taxi.pickup_features(train_raw.where(taxi.plausible())), taxi.pickup_features(test_raw)

    def fit(rows: DataFrame, target: str) -> PipelineModel:
        flags = ["is_weekend"] if target == "Airport_fee" else ["is_airport", "is_weekend"]
        return m.fit_linear(rows, replace(PICKUP_TIME, passthrough=flags), target)

    return m.per_target_benchmark(train, test, taxi.PARTS, fit)


def _route_ridge(target: str):
    encoder = TargetEncoder(["route_id", "route_period_id"], target)

    def fit(rows: DataFrame) -> PipelineModel:
        encoded = encoder.fit_transform_crossfit(rows, [taxi.ROW_ID])
        return PipelineModel([encoder.fit(rows), m.fit_ridge(encoded, ROUTE_STATISTICS, target)])

    return fit


def _temporal_sides(raw: DataFrame, sample: int | None) -> tuple[DataFrame, DataFrame]:
    """All audited trips before and after the cut, or a sample of each side."""
    trips, _, _ = taxi.audited_trips(raw)
    if sample is None:
        return sp.sides(sp.temporal_holdout(trips, taxi.PICKUP, taxi.HOLDOUT))
    return sp.sides(sp.temporal_split_sample(trips, taxi.PICKUP, taxi.HOLDOUT, sample, [taxi.ROW_ID]))


def route_experiments(raw: DataFrame, sample: int | None = None) -> DataFrame:
    """A constant, and ridge regressions that know more and more about the route."""
    train, test = _temporal_sides(raw, sample)
    target = taxi.TOTAL
    return m.compare_models(train, test, target, {
        "median": lambda rows: m.ConstantModel(median_value(rows, target)),
        "zones": lambda rows: m.fit_ridge(rows, ROUTE_BASE, target),
        "zones_log_target": lambda rows: m.fit_ridge(rows, ROUTE_BASE, target, log_target=True),
        # The zone columns of a trip always sum to one, which is what an intercept would add.
        "zones_and_route": lambda rows: m.fit_ridge(rows, ROUTE_MATCH, target, fit_intercept=False),
        "zones_and_route_means": _route_ridge(target),
    })


def route_part_benchmark(raw: DataFrame, sample: int | None = None) -> DataFrame:
    """Route statistics for each part of the total."""
    train, test = _temporal_sides(raw, sample)
    return m.per_target_benchmark(train, test, taxi.PARTS, lambda rows, target: _route_ridge(target)(rows))


def per_part_run(raw: DataFrame, path: str, kinds: Mapping[str, str] = PART_KINDS, **options) -> tuple[DataFrame, str]:
    """(metrics per part and of the summed total, "trained" or "loaded")."""
    trips = taxi.clean_trips(raw)
    train, test = sp.sides(sp.temporal_holdout(trips, taxi.PICKUP, taxi.HOLDOUT))
    bundles, source = m.train_or_reuse(train, kinds, PER_PART, path, **options)
    return m.evaluate_bundles(train, test, bundles, taxi.TOTAL), source


def multi_output_cv(raw: DataFrame, folds: int = 5, **forest) -> DataFrame:
    """k-fold scores of one forest per part and of their sum."""
    trips, targets = taxi.multi_output_trips(raw)
    return m.cross_validate(
        trips, [taxi.ROW_ID], targets, lambda rows: m.fit_forest_multi(rows, MULTI_OUTPUT, targets, **{**MULTI_OUTPUT_FOREST, **forest}), folds
    )


def multi_output_run(raw: DataFrame, max_train_rows: int | None = None, **forest) -> DataFrame:
    """Forests for the parts on complete training trips; their sum scored on every test trip.

    ``max_train_rows`` is for trial runs: it fits on that many trips, chosen by hash.
    """
    train_raw, test_raw = taxi.common_split(raw)
    train = taxi.training_trips(train_raw)
    if max_train_rows is not None:
        train = sp.fixed_sample(train, max_train_rows, [taxi.ROW_ID])
    prep = m.Preprocessing(
        numeric=["passenger_count", "trip_distance", "pickup_hour", "pickup_weekday", "is_weekend", "trip_duration_minutes"],
        categorical=["VendorID", "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type"],
        categorical_fill="unknown", scale=False, one_hot=False, forbidden=FORBIDDEN,
    )
    fit_rows = time_features(train, taxi.PICKUP)
    test = time_features(test_raw.withColumn("trip_duration_minutes", taxi.minutes()), taxi.PICKUP)
    model = m.fit_forest_multi(fit_rows, prep, taxi.PARTS, **{**PART_FOREST, **forest})
    with m.kept(m.sum_of_targets(model.transform(test), taxi.PARTS).select(taxi.TOTAL, "total_prediction")) as scored:
        return _fixed(ev.regression_metrics(scored, taxi.TOTAL, "total_prediction"))
