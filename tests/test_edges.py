import datetime as dt

from landing_helpers import landing_rows, ts

from farebox.operators import facts, kpis, marts, silver
from farebox.operators import forecast as fc
from farebox.schemas import MANIFEST_SCHEMA
from farebox.sources import landing as ld


def _series(spark, n):
    return spark.createDataFrame(
        [("green", 7, dt.datetime(2024, 3, 1) + dt.timedelta(hours=h), float(h % 5)) for h in range(n)],
        "service_type string, taxi_zone_key int, target_timestamp timestamp_ntz, demand double")


def test_series_of_48_and_49_hours(spark):
    assert fc.forecast_features(fc.densify_hourly(_series(spark, 48)), 1).count() == 0
    one = fc.forecast_features(fc.densify_hourly(_series(spark, 49)), 24).collect()
    assert len(one) == 1 and one[0]["target"] == 48 % 5 and one[0]["lag_origin"] == 24 % 5
    assert one[0]["service_code"] == 1.0


def test_zero_distance_gives_null_minutes_per_mile(spark):
    rows = [dict(service_type="yellow", pickup_datetime=ts("2024-01-01 10:00:00"),
                 dropoff_datetime=ts("2024-01-01 10:12:00"), pickup_location_id=1, dropoff_location_id=2,
                 trip_distance=0.0, total_amount=5.0)]
    p = facts.zone_hour_partials(silver.silver_trips(silver.stg_trip_records(landing_rows(spark, rows))))
    z = spark.createDataFrame([(1, "B", "Z1", "x")], "taxi_zone_key int, borough string, zone_name string, service_zone string")
    r = marts.mart_congestion_proxy(facts.fact_zone_hourly_demand(p), z).first()
    assert r["average_trip_distance"] == 0.0 and r["minutes_per_mile_proxy"] is None
    assert r["average_speed_mph"] == 0.0


def test_manifest_upsert_is_idempotent(spark):
    base = dict(file_id=0, source_kind="tlc", service_type="green", year=2024, month=5,
                filename="green_tripdata_2024-05.parquet", source_url="u", size_bytes=3, sha256="s",
                row_count=2, status="VALIDATED", first_run_id="r1", last_run_id="r1", updated_at=None)
    new = spark.createDataFrame([tuple(base[f.name] for f in MANIFEST_SCHEMA.fields)], MANIFEST_SCHEMA)
    empty = spark.createDataFrame([], MANIFEST_SCHEMA)
    once = ld.upsert_manifest(new, empty)
    twice = ld.upsert_manifest(new, once)
    # all but the time of the update, which is that of the run
    assert sorted(map(tuple, once.drop("updated_at").collect())) == sorted(map(tuple, twice.drop("updated_at").collect()))
    assert once.first()["file_id"] == 1


def test_enrich_weather_left_join(spark):
    hourly = spark.createDataFrame([(20240101, 5, 10), (20240101, 6, 3)], "date_key int, hour_key short, trip_count long")
    weather = spark.createDataFrame([(20240101, 5, 2.5)], "date_key int, hour_key short, precipitation_mm double")
    got = {r["hour_key"]: r["precipitation_mm"] for r in kpis.enrich_weather(hourly, weather).collect()}
    assert got == {5: 2.5, 6: None}
