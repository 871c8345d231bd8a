from landing_helpers import landing_rows, ts

from farebox.fixtures import fixture_inputs
from farebox.operators import dimensions as dims
from farebox.operators import facts, marts, silver


def _gold(spark, rows):
    s = silver.silver_trips(silver.stg_trip_records(landing_rows(spark, rows)))
    return s, facts.zone_hour_partials(s)


def test_totals_reconcile_on_fixture(spark):
    landing, _ = fixture_inputs(spark, "/root/testdata/sf0.001")
    s = silver.silver_trips(silver.stg_trip_records(landing))
    hourly, daily = facts.hourly_and_daily(s)
    n = s.count()
    assert hourly.agg({"trip_count": "sum"}).first()[0] == n
    assert daily.agg({"trip_count": "sum"}).first()[0] == n
    assert hourly.filter("trip_count <= 0").count() == 0


def test_daily_rollup_equals_direct_average(spark):
    rows = [dict(service_type="green", pickup_datetime=ts(f"2024-03-02 {h:02d}:10:00"),
                 dropoff_datetime=ts(f"2024-03-02 {h:02d}:{10 + m}:00"), pickup_location_id=7,
                 dropoff_location_id=8, trip_distance=d, total_amount=a)
            for h, m, d, a in [(1, 5, 1.0, 10.0), (1, 10, None, None), (3, 20, 2.5, 7.25), (3, 0, 4.0, 3.0)]]
    s, p = _gold(spark, rows)
    daily = facts.fact_zone_daily_performance(p).first()
    assert daily["trip_count"] == 4 and daily["revenue_observation_count"] == 3
    assert daily["observed_trip_amount"] == 20.25
    assert abs(daily["average_duration_minutes"] - 35 / 4) < 1e-12
    assert abs(daily["average_trip_distance"] - 7.5 / 3) < 1e-12
    speeds = [1.0 / (5 / 60), 2.5 / (20 / 60)]              # zero-minute and NULL-distance trips excluded
    assert abs(daily["average_speed_mph"] - sum(speeds) / 2) < 1e-9
    assert abs(daily["occupied_hours"] - 35 / 60) < 1e-12
    assert facts.fact_zone_hourly_demand(p).count() == 2


def test_dim_date_and_empty_silver(spark):
    rows = [dict(pickup_datetime=ts("2024-12-30 23:00:00"), dropoff_datetime=ts("2024-12-31 00:10:00"),
                 pickup_location_id=1, dropoff_location_id=2),
            dict(pickup_datetime=ts("2025-01-05 01:00:00"), dropoff_datetime=ts("2025-01-05 01:10:00"),
                 pickup_location_id=1, dropoff_location_id=2)]
    s, _ = _gold(spark, rows)
    d = dims.dim_date(s).orderBy("full_date").collect()
    assert len(d) == 7
    first = d[0]
    assert first["date_key"] == 20241230 and first["iso_day_of_week"] == 1 and first["day_name"] == "Monday"
    assert first["iso_week"] == 1 and first["quarter"] == 4 and not first["is_weekend"]
    assert d[-1]["is_weekend"] and d[-1]["day_name"] == "Sunday"
    empty = s.filter("1 = 0")
    assert dims.dim_date(empty).count() == 0


def test_dim_time_and_services(spark):
    t = {r["hour_key"]: r for r in dims.dim_time(spark).collect()}
    assert len(t) == 24 and t[7]["hour_label"] == "07:00" and t[7]["hour_start"] == "07:00:00"
    assert [t[h]["day_period"] for h in (0, 5, 6, 9, 10, 15, 16, 19, 20, 23)] == [
        "overnight", "overnight", "morning_peak", "morning_peak", "midday", "midday",
        "evening_peak", "evening_peak", "night", "night"]
    svc = {r["service_type_key"]: r for r in dims.dim_service_type(spark).collect()}
    assert not svc["fhv"]["supports_distance"] and svc["fhvhv"]["supports_observed_amount"]


def test_service_comparison_keeps_service_without_trips(spark):
    rows = [dict(service_type="yellow", pickup_datetime=ts("2024-01-01 10:00:00"),
                 dropoff_datetime=ts("2024-01-01 10:30:00"), pickup_location_id=3, dropoff_location_id=4,
                 trip_distance=2.0, total_amount=None)]
    _, p = _gold(spark, rows)
    out = {r["service_type_key"]: r for r in
           marts.mart_service_comparison(dims.dim_service_type(spark), facts.fact_zone_daily_performance(p)).collect()}
    assert len(out) == 4
    assert out["green"]["trip_count"] is None and out["green"]["active_days"] == 0
    assert out["green"]["active_pickup_zones"] == 0
    assert out["yellow"]["trip_count"] == 1 and out["yellow"]["observed_amount_per_priced_trip"] is None


def test_driver_opportunity_and_profit(spark):
    rows = [dict(service_type="yellow", pickup_datetime=ts("2024-01-01 10:00:00"),
                 dropoff_datetime=ts("2024-01-01 10:30:00"), pickup_location_id=z, dropoff_location_id=4,
                 trip_distance=2.0, total_amount=10.0) for z in (1, 1, 2)]
    _, p = _gold(spark, rows)
    zones = spark.createDataFrame([(1, "B", "Z1", "Boro Zone"), (2, "B", "Z2", "Airports")],
                                  "taxi_zone_key int, borough string, zone_name string, service_zone string")
    h = facts.fact_zone_hourly_demand(p)
    score = {r["taxi_zone_key"]: r["relative_demand_score"] for r in
             marts.mart_driver_opportunity(h, zones).collect()}
    assert score == {1: 100.0, 2: 50.0}
    prof = {r["taxi_zone_key"]: r for r in
            marts.mart_profitability_scenario(facts.fact_zone_daily_performance(p), zones).collect()}
    assert abs(prof[1]["estimated_net_contribution_scenario"] - (20 - 4 - 2 * 2 * 0.35 - 2 * 1.5)) < 1e-9
    assert str(prof[1]["assumed_commission_rate"]) == "0.2000"
    cong = marts.mart_congestion_proxy(h, zones).first()
    assert cong["minutes_per_mile_proxy"] == 15.0
