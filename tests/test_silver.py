from landing_helpers import landing_rows, ts

from farebox.operators import facts, silver

P, D = ts("2024-01-15 08:00:00"), ts("2024-01-15 08:18:00")
OK = dict(pickup_datetime=P, dropoff_datetime=D, pickup_location_id=161, dropoff_location_id=236,
          trip_distance=3.4, total_amount=24.5)


def reasons(spark, rows):
    stg = silver.stg_trip_records(landing_rows(spark, rows))
    return [r["invalid_reason"] for r in stg.orderBy("source_row_number").collect()]


def test_each_reason_in_precedence_order(spark):
    rows = [
        {**OK, "pickup_datetime": None},
        {**OK, "dropoff_datetime": None},
        {**OK, "dropoff_datetime": ts("2024-01-15 07:59:59")},
        {**OK, "pickup_location_id": None},
        {**OK, "dropoff_location_id": None},
        {**OK, "pickup_location_id": 266},
        {**OK, "dropoff_location_id": 0},
        {**OK, "trip_distance": -0.1},
        {**OK, "total_amount": -1.0},
        OK,
        # two broken rules: the earlier one wins
        {**OK, "pickup_location_id": None, "trip_distance": -5.0},
    ]
    assert reasons(spark, rows) == [
        "missing_pickup_datetime", "missing_dropoff_datetime", "dropoff_before_pickup",
        "missing_pickup_location", "missing_dropoff_location", "invalid_pickup_location",
        "invalid_dropoff_location", "negative_trip_distance", "negative_total_amount", None,
        "missing_pickup_location"]


def test_zone_boundaries_zero_minutes_and_null_money(spark):
    rows = [{**OK, "pickup_location_id": 1}, {**OK, "pickup_location_id": 265},
            {**OK, "pickup_location_id": 0}, {**OK, "dropoff_location_id": 266},
            {**OK, "dropoff_datetime": P},                       # zero-minute trip is valid
            {**OK, "trip_distance": None, "total_amount": None}]  # NULL money / distance valid
    assert reasons(spark, rows) == [None, None, "invalid_pickup_location", "invalid_dropoff_location",
                                    None, None]


def test_demo_trips_duration_speed_and_key(spark):
    rows = [OK, dict(pickup_datetime=ts("2024-01-15 09:00:00"), dropoff_datetime=ts("2024-01-15 09:22:00"),
                     pickup_location_id=236, dropoff_location_id=161, trip_distance=4.1, total_amount=29.0)]
    ft = facts.fact_trip(silver.silver_trips(silver.stg_trip_records(landing_rows(spark, rows))))
    got = ft.orderBy("source_row_number").collect()
    assert [r["duration_minutes"] for r in got] == [18.0, 22.0]
    assert abs(got[0]["average_speed_mph"] - 3.4 / 0.3) < 1e-12
    assert abs(got[1]["average_speed_mph"] - 4.1 / (22 / 60)) < 1e-12
    assert got[0]["pickup_date_key"] == 20240115 and got[0]["pickup_hour_key"] == 8
    import hashlib
    assert got[0]["trip_id"] == hashlib.md5(b"demo|1|1").hexdigest()


def test_zero_duration_speed_and_null_distance(spark):
    rows = [{**OK, "dropoff_datetime": P}, {**OK, "trip_distance": None}]
    ft = facts.fact_trip(silver.silver_trips(silver.stg_trip_records(landing_rows(spark, rows))))
    assert [r["average_speed_mph"] for r in ft.orderBy("source_row_number").collect()] == [None, None]


def test_subsecond_duration(spark):
    rows = [{**OK, "dropoff_datetime": ts("2024-01-15 08:00:30.500000")}]
    stg = silver.stg_trip_records(landing_rows(spark, rows)).first()
    assert stg["duration_minutes"] == 30.5 / 60


def test_silver_plus_quarantine_is_landing(spark):
    from farebox.fixtures import fixture_inputs
    landing, _ = fixture_inputs(spark, "/root/testdata/sf0.001")
    s, q = silver.split_silver(landing)
    assert s.count() + q.count() == landing.count()
    assert len(s.columns) == 16 and "quarantined_at" in q.columns
    by = dict(q.groupBy("invalid_reason").count().collect())
    assert by["invalid_pickup_location"] == 122 and s.count() == 798
