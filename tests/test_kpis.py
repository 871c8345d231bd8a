import datetime as dt

from landing_helpers import landing_rows, ts

from farebox.operators import dimensions as dims
from farebox.operators import facts, kpis, presentation, silver
from farebox.operators import forecast as fc
from pyspark.sql import functions as F

ZONES = [(1, "A", "Z1", "Boro Zone"), (2, "A", "Z2", "Boro Zone"), (3, "B", "Z3", "Airports")]


def _trips(spark):
    rows = [dict(service_type="yellow", pickup_datetime=ts(p), dropoff_datetime=ts(d), pickup_location_id=pu,
                 dropoff_location_id=do, trip_distance=dist, total_amount=amt)
            for p, d, pu, do, dist, amt in [
                ("2019-06-01 08:00:00", "2019-06-01 08:30:00", 1, 2, 5.0, 20.0),
                ("2019-06-01 08:10:00", "2019-06-01 08:40:00", 1, 3, 0.0, 10.0),
                ("2021-06-05 23:00:00", "2021-06-05 23:30:00", 3, 3, 2.0, None)]]
    return silver.silver_trips(silver.stg_trip_records(landing_rows(spark, rows)))


def test_unit_economics(spark):
    r = kpis.kpi_unit_economics(_trips(spark)).first()
    assert r["trip_count"] == 3 and r["priced_trip_count"] == 2
    assert r["amount_per_priced_trip"] == 15.0 and r["amount_per_mile"] == 4.0
    assert r["amount_per_occupied_hour"] == 30.0 / 1.0


def test_flows_pairs_and_rankings(spark):
    ft = facts.fact_trip(_trips(spark))
    z = spark.createDataFrame(ZONES, "taxi_zone_key int, borough string, zone_name string, service_zone string")
    flows = {(r["pickup_borough"], r["dropoff_borough"]): (r["trip_count"], r["cross_borough"])
             for r in kpis.borough_flows(ft, z).collect()}
    assert flows == {("A", "A"): (1, False), ("A", "B"): (1, True), ("B", "B"): (1, False)}
    top = kpis.od_pairs_top(ft, z, k=2).collect()
    assert len(top) == 2 and {r["pickup_zone_name"] for r in top} == {"Z1"}
    rank = {r["taxi_zone_key"]: r["zone_rank"] for r in kpis.zone_ranking(ft, "pickup").collect()}
    assert rank == {1: 1, 3: 2}


def test_periods_profile_coherence_grid(spark):
    t = _trips(spark)
    hourly, daily = facts.hourly_and_daily(t)
    per = {r["period"]: r["trip_count"] for r in kpis.period_comparison(daily).collect()}
    assert per == {"2018_2019": 2, "2020_2021": 1}
    prof = {r["day_period"]: r for r in kpis.demand_profile(hourly, "day_period").collect()}
    assert prof["morning_peak"]["trip_count"] == 2 and prof["night"]["trip_count"] == 1
    assert abs(prof["morning_peak"]["demand_index"] - 2 / 1.5) < 1e-12
    grid = kpis.scenario_grid(daily, [{"name": "x", "commission_rate": 0.5, "variable_cost_per_mile": 1.0,
                                       "fixed_cost_per_trip": 1.0}]).collect()
    first = [r for r in grid if r["date_key"] == 20190601][0]
    assert first["estimated_net_contribution"] == 30 - 15 - 2.5 * 2 - 2
    assert first["break_even_amount_per_trip"] == (2.5 + 1.0) / 0.5
    cal = kpis.enrich_calendar(hourly, dims.dim_date(t),
                               spark.createDataFrame([(dt.date(2019, 6, 2), "x")], "holiday_date date, holiday_name string"))
    r = {x["date_key"]: x for x in cal.collect()}
    assert r[20190601]["season"] == "summer" and r[20190601]["is_holiday_eve"] and not r[20190601]["is_holiday"]
    land = landing_rows(spark, [dict(source_filename="yellow_tripdata_2024-01.parquet", pickup_datetime=ts(p))
                                for p in ("2024-01-10 00:00:00", "2023-12-31 23:00:00", "2023-12-20 00:00:00")])
    coh = kpis.file_month_coherence(land).first()
    assert coh["outside_month"] == 2 and coh["outside_tolerance"] == 1


def test_quality_profile(spark):
    stg = silver.stg_trip_records(landing_rows(spark, [dict(trip_distance=1.5), dict(trip_distance=None)]))
    prof = {r["column_name"]: r for r in kpis.quality_profile(stg).collect()}
    assert prof["trip_distance"]["null_count"] == 1 and prof["trip_distance"]["null_pct"] == 50.0
    assert prof["trip_distance"]["max_value"] == 1.5 and prof["service_type"]["min_value"] is None
    pct = {(r["column_name"], r["probability"]): r["percentile"] for r in kpis.quality_percentiles(stg).collect()}
    assert {p: v for (c, p), v in pct.items() if c == "trip_distance"} == {0.01: 1.5, 0.5: 1.5, 0.99: 1.5}


def test_presentation(spark):
    runs = spark.createDataFrame([("r1", "SUCCEEDED", dt.datetime(2024, 1, 1)), ("r2", "FAILED", dt.datetime(2024, 1, 2))],
                                 "model_run_id string, status string, started_at timestamp")
    assert presentation.latest_model_status(runs).first()["status"] == "FAILED"
    land = landing_rows(spark, [dict(source_filename="a"), dict(source_filename="a"), dict(source_filename="b")])
    assert presentation.landing_rows_for_file(land, "a").first()[0] == 2


def test_poisson_candidate(spark, tmp):
    panel = fc.synthetic_hourly_demand(spark, days=31).withColumnRenamed("timestamp", "target_timestamp")
    split = fc.temporal_split(fc.forecast_features(fc.densify_hourly(panel), 1), fc.temporal_cutoff(panel, min_hours=300))
    preds, _, models = fc.train_candidates(split.checkpoint(), tmp, num_trees=3, max_iter=2, extra=("poisson",))
    m = {r["model_name"]: r for r in fc.forecast_metrics(preds).collect()}
    assert set(m) == {"seasonal_naive", "extra_trees", "hist_gradient_boosting", "poisson_glm"}
    assert m["poisson_glm"]["mae"] < m["seasonal_naive"]["mae"] * 2


def test_quality_percentiles_are_exact(spark):
    """Brute force on the sf0.001 fixture, and a value that most rows share."""
    import math

    from farebox.fixtures import fixture_inputs
    landing, _ = fixture_inputs(spark, "/root/testdata/sf0.001")
    stg = silver.stg_trip_records(landing)
    stg = stg.withColumn("same", F.when(F.xxhash64("trip_id") % 5 != 0, 1.0).otherwise(F.col("source_row_number").cast("double")))
    cols = ("trip_distance", "total_amount", "duration_minutes", "same")
    got = {(r["column_name"], r["probability"]): r["percentile"] for r in kpis.quality_percentiles(stg, cols).collect()}
    for col in cols:
        vals = sorted(r[0] for r in stg.select(col).collect() if r[0] is not None)
        for p in (0.01, 0.5, 0.99):
            assert got[col, p] == vals[math.ceil(p * len(vals)) - 1]


def test_duplicate_profile(spark):
    land = landing_rows(spark, [dict(source_row_number=1), dict(source_row_number=1), dict(source_row_number=2)])
    r = kpis.duplicate_profile(land).first()
    assert (r["rows"], r["distinct_keys"], r["duplicated_keys"], r["duplicate_rows"]) == (3, 2, 1, 1)


def test_status_listings(spark):
    runs = spark.createDataFrame(
        [("r1", "spark", "demo", "SUCCEEDED", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1)),
         ("r2", "spark", "full", "RUNNING", dt.datetime(2024, 1, 2), None)],
        "run_id string, orchestrator string, mode string, status string, started_at timestamp, finished_at timestamp")
    assert [r["run_id"] for r in presentation.run_history(runs).collect()] == ["r2", "r1"]
    files = spark.createDataFrame(
        [("yellow", f"f{i}", "VALIDATED", 0, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(60)],
        "service_type string, filename string, status string, retry_count int, last_attempt_at timestamp, updated_at timestamp")
    top = presentation.recent_files(files).collect()
    assert top[0].asDict().keys() == {"service_type", "filename", "status", "retry_count", "last_attempt_at"}
    assert len(top) == 50 and top[0]["filename"] == "f59" and top[-1]["filename"] == "f10"


def test_an_outlier_does_not_put_all_values_in_one_task(spark):
    """20,000 distinct values and one a billion times larger: the values lie in many partitions, ranks stay exact."""
    from pyspark.sql import functions as F
    values = spark.range(20_000).select(F.col("id").cast("double").alias("trip_distance")).unionByName(
        spark.createDataFrame([(1e13,)], "trip_distance double"))
    had = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["probability"]: r["percentile"] for r in kpis.quality_percentiles(values, ("trip_distance",), (0.0001, 0.5, 1.0)).collect()}
        parts = values.repartitionByRange("trip_distance").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", had)
    assert got == {0.0001: 2.0, 0.5: 10000.0, 1.0: 1e13}
    assert len(parts) == 8 and max(r["count"] for r in parts) < 5000


def test_two_holidays_on_one_date_keep_its_rows_single(spark):
    hourly = spark.createDataFrame([(20240101, 5), (20240102, 5)], "date_key int, hour_key int")
    days = spark.createDataFrame([(20240101, dt.date(2024, 1, 1), 1), (20240102, dt.date(2024, 1, 2), 1)], "date_key int, full_date date, month int")
    holidays = spark.createDataFrame([(dt.date(2024, 1, 2), "A"), (dt.date(2024, 1, 2), "B")], "holiday_date date, holiday_name string")
    got = {r["date_key"]: (r["is_holiday"], r["is_holiday_eve"]) for r in kpis.enrich_calendar(hourly, days, holidays).collect()}
    assert got == {20240101: (False, True), 20240102: (True, False)} and kpis.enrich_calendar(hourly, days, holidays).count() == 2
