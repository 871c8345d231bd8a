import datetime as dt

import pytest
from pyspark.sql import functions as F

from farebox.operators import forecast as fc


@pytest.fixture(scope="module")
def panel120(spark):
    return fc.synthetic_hourly_demand(spark, days=120).withColumnRenamed("timestamp", "target_timestamp")


def test_synthetic_panel_is_deterministic(spark):
    a = fc.synthetic_hourly_demand(spark, days=31)
    b = fc.synthetic_hourly_demand(spark, days=31)
    assert a.count() == 31 * 24 * 4 * 3
    assert a.exceptAll(b).count() == 0
    assert a.filter(F.col("demand") < 0).count() == 0


def test_golden_split_and_no_overlap(spark, panel120):
    dense = fc.densify_hourly(panel120)
    f24 = fc.forecast_features(dense, 24)
    assert len(fc.FEATURES) == 10 and all(c in f24.columns for c in fc.FEATURES)
    split = fc.temporal_split(f24, fc.temporal_cutoff(dense))
    hours = {r[0] for r in f24.select("target_timestamp").distinct().collect()}
    assert {r[0] for r in fc.target_hours(panel120).collect()} == hours
    assert split.first()["cutoff"] == dt.datetime(2024, 4, 6, 9, 0)
    counts = dict(split.groupBy("split").count().collect())
    assert counts["test"] == 6804
    mx = split.filter("split = 'train'").agg(F.max("target_timestamp")).first()[0]
    mn = split.filter("split = 'test'").agg(F.min("target_timestamp")).first()[0]
    assert mx < mn


def test_unknown_horizon_and_history_guard(spark, panel120):
    with pytest.raises(ValueError):
        fc.forecast_features(fc.densify_hourly(panel120), 2)
    short = fc.synthetic_hourly_demand(spark, days=20).withColumnRenamed("timestamp", "target_timestamp")
    with pytest.raises(ValueError):
        fc.temporal_cutoff(short)


def _series(spark, points):
    return spark.createDataFrame(
        [("yellow", 1, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float(v)) for h, v in points],
        "service_type string, taxi_zone_key int, target_timestamp timestamp_ntz, demand double")


def test_densify_fills_gap_with_zero_and_collapses_duplicates(spark):
    d = fc.densify_hourly(_series(spark, [(0, 3), (2, 5), (2, 7)])).orderBy("target_timestamp").collect()
    assert [r["demand"] for r in d] == [3.0, 0.0, 7.0]


def test_features_match_a_plain_loop(spark):
    import math
    vals = [float((h * 7) % 11) for h in range(60)]
    dense = _series(spark, list(enumerate(vals)))
    assert fc.forecast_features(dense, 24).count() == 12          # targets 48..59
    rows = fc.forecast_features(dense, 1).orderBy("target_timestamp").collect()
    assert len(rows) == 12
    r = rows[0]                                                   # target index 48, origin 47
    assert r["lag_origin"] == vals[47] and r["lag_origin_1"] == vals[46] and r["lag_origin_24"] == vals[23]
    assert abs(r["rolling_mean_24"] - sum(vals[24:48]) / 24) < 1e-12
    assert r["baseline"] == vals[24] and r["target"] == vals[48]
    t = dt.datetime(2024, 1, 1) + dt.timedelta(hours=48)
    assert abs(r["hour_sin"] - math.sin(2 * math.pi * t.hour / 24)) < 1e-12
    assert abs(r["weekday_cos"] - math.cos(2 * math.pi * t.weekday() / 7)) < 1e-12
    assert r["service_code"] == 0.0 and r["zone_code"] == 1.0


def _preds(spark, rows):
    return spark.createDataFrame(rows, "model_name string, horizon_hours short, actual_demand double, "
                                       "predicted_demand double")


def test_metrics_edge_cases(spark):
    m = {r["model_name"]: r for r in fc.forecast_metrics(_preds(spark, [
        ("zeros", 1, 0.0, 1.0), ("zeros", 1, 0.0, 0.0),
        ("one", 1, 3.0, 1.0),
        ("const", 1, 2.0, 2.0), ("const", 1, 2.0, 2.0),
        ("lin", 1, 1.0, 2.0), ("lin", 1, 3.0, 2.0)])).collect()}
    assert m["zeros"]["wape"] is None and m["zeros"]["mae"] == 0.5
    assert m["one"]["r2"] is None and m["one"]["sample_count"] == 1
    assert m["const"]["r2"] == 1.0
    assert m["lin"]["r2"] == 0.0 and m["lin"]["rmse"] == 1.0 and m["lin"]["wape"] == 0.5


def test_selection_tie_prefers_candidate_order(spark):
    met = spark.createDataFrame([("hist_gradient_boosting", 1, 1.0), ("seasonal_naive", 1, 1.0),
                                 ("extra_trees", 1, 1.0), ("extra_trees", 24, 0.5),
                                 ("seasonal_naive", 24, None)],
                                "model_name string, horizon_hours int, mae double")
    sel = {(r["horizon_hours"], r["model_name"]) for r in fc.select_model(met).filter("is_selected").collect()}
    assert sel == {(1, "seasonal_naive"), (24, "extra_trees")}


def test_training_run_small(spark, tmp, panel120):
    from farebox.plans.training import latest_run_status, train_demand
    out = train_demand(spark, tmp, mode="full", panel=panel120, num_trees=5, max_iter=3)
    assert [r["horizon_hours"] for r in out["results"]] == [1, 24]
    assert all(r["test_samples"] == 6804 and r["cutoff"] == "2024-04-06T09:00:00" for r in out["results"])
    runs = spark.read.parquet(f"{tmp}/model_runs")
    assert latest_run_status(runs).first()["status"] == "SUCCEEDED"
    metrics = spark.read.parquet(f"{tmp}/model_metrics")
    assert metrics.count() == 6 and metrics.filter("is_selected").count() == 2
    preds = spark.read.parquet(f"{tmp}/predictions")
    assert preds.count() == 6 * 6804 and preds.filter("predicted_demand < 0").count() == 0


def test_two_training_runs_are_identical(spark, tmp):
    """Reproducibility: same panel, same seed → same cutoff, selection and metrics."""
    from farebox.plans.training import train_demand
    panel = fc.synthetic_hourly_demand(spark, days=40).withColumnRenamed("timestamp", "target_timestamp")
    a = train_demand(spark, f"{tmp}/a", mode="full", panel=panel, num_trees=4, max_iter=3)
    b = train_demand(spark, f"{tmp}/b", mode="full", panel=panel, num_trees=4, max_iter=3)
    assert a["results"] == b["results"]
    ma = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/a/model_metrics").drop("model_run_id").collect())
    mb = sorted(tuple(r) for r in spark.read.parquet(f"{tmp}/b/model_metrics").drop("model_run_id").collect())
    assert ma == mb


def test_synthetic_demand_has_no_ceiling(spark):
    demand = fc.synthetic_hourly_demand(spark, days=2, zones=tuple(range(1, 266)))
    top = demand.groupBy("demand").count().orderBy(F.desc("demand")).first()
    assert top["demand"] > 400 and top["count"] < 5
