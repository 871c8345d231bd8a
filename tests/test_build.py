import os

from landing_helpers import landing_rows, ts

from farebox.plans.build import build

OK = dict(pickup_datetime=ts("2024-01-15 08:00:00"), dropoff_datetime=ts("2024-01-15 08:18:00"),
          pickup_location_id=1, dropoff_location_id=2, trip_distance=3.4, total_amount=24.5)


def _zones(spark):
    return spark.createDataFrame([(1, "B", "Z1", "Boro Zone"), (2, "B", "Z2", "Airports")],
                                 "location_id int, borough string, zone_name string, service_zone string")


def test_full_build_and_rerun(spark, tmp):
    land = landing_rows(spark, [OK, {**OK, "pickup_location_id": 0}])
    for _ in range(2):                                   # full refresh: a rerun gives the same tables
        res = build(spark, land, _zones(spark), target_dir=os.path.join(tmp, "wh"))
        assert all(v == "SUCCEEDED" for v in res.status.values())
        assert len(res.tests) == 83 and all(t["status"] == "PASS" for t in res.tests)
        assert res.models["trips"].count() == 1 and res.models["trip_quarantine"].count() == 1
        assert spark.table("mart_driver_opportunity").count() == 1


def test_failing_source_test_skips_downstream(spark, tmp):
    land = landing_rows(spark, [{**OK, "service_type": "taxi"}])
    res = build(spark, land, _zones(spark), target_dir=os.path.join(tmp, "wh"))
    failed = {t["check_name"] for t in res.tests if t["status"] == "FAIL"}
    assert "accepted_values__landing__service_type" in failed
    assert res.status["stg_trip_records"] == "SKIPPED" and res.status["mart_mobility_overview"] == "SKIPPED"
    assert res.status["dim_time"] == "SUCCEEDED" and res.status["dim_taxi_zone"] == "SUCCEEDED"


def test_select_builds_only_upstream(spark, tmp):
    land = landing_rows(spark, [OK])
    res = build(spark, land, _zones(spark), target_dir=os.path.join(tmp, "wh"),
                select=["fact_zone_hourly_demand"], run_tests=False)
    assert set(res.status) == {"stg_trip_records", "trips", "zone_hour_partials", "fact_zone_hourly_demand"}


def test_build_records_control_tables(spark, tmp):
    from farebox.operators import presentation
    land = landing_rows(spark, [OK])
    ctl = os.path.join(tmp, "control")
    res = build(spark, land, _zones(spark), target_dir=os.path.join(tmp, "wh"), control_dir=ctl)
    runs = spark.read.parquet(os.path.join(ctl, "pipeline_runs"))
    hist = presentation.run_history(runs).collect()
    assert len(hist) == 1 and hist[0]["status"] == "SUCCEEDED" and hist[0]["run_id"] == res.run_id
    assert hist[0]["finished_at"] is not None
    final = runs.filter("status = 'SUCCEEDED'").first()
    assert (final["rows_read"], final["rows_valid"], final["rows_rejected"]) == (1, 1, 0)
    assert presentation.latest_model_status(runs.withColumnRenamed("run_id", "model_run_id")).first()["status"] \
        == "SUCCEEDED"
    assert (final["start_date"], final["end_date"]) == (final["end_date"], final["start_date"]) and final["started_at"]
    from farebox.operators import checks as chk
    for table in ("pipeline_runs", "pipeline_tasks", "data_quality_results"):
        broken = chk.check_control_constraints(table, spark.read.parquet(os.path.join(ctl, table))).collect()
        assert all(r["failures"] == 0 for r in broken), broken
    tasks = spark.read.parquet(os.path.join(ctl, "pipeline_tasks"))
    assert tasks.count() == 16 and tasks.filter("status != 'SUCCEEDED'").count() == 0
    dq = spark.read.parquet(os.path.join(ctl, "data_quality_results"))
    assert dq.count() == 83 and dq.filter("status = 'PASS'").count() == 83


def test_empty_landing_passes_all_tests(spark, tmp):
    from farebox.schemas import LANDING_SCHEMA
    res = build(spark, spark.createDataFrame([], LANDING_SCHEMA), _zones(spark), target_dir=os.path.join(tmp, "wh"))
    assert {t["check_name"] for t in res.tests if t["status"] != "PASS"} == set()


def test_a_failed_refresh_leaves_the_old_table(spark, tmp):
    import pytest
    from pyspark.sql import functions as F
    from farebox.sources.versions import current_path, expire_versions, read_current, swap_in
    path = os.path.join(tmp, "t")
    with pytest.raises(FileNotFoundError):
        read_current(spark, path)
    assert swap_in(spark.range(10), path).count() == 10
    first = current_path(spark, path)
    held = read_current(spark, path)
    broken = spark.range(1000).repartition(4).withColumn("id", F.when(F.col("id") == 777, F.raise_error(F.lit("half-way")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="half-way"):
        swap_in(broken, path)
    assert current_path(spark, path) == first and read_current(spark, path).count() == 10
    assert swap_in(spark.range(20), path).count() == 20
    assert held.count() == 10 and read_current(spark, path).count() == 20    # a reader keeps the version it resolved
    swap_in(spark.range(30), path)
    assert expire_versions(spark, path, keep=2) == 1 and read_current(spark, path).count() == 30
    empty = swap_in(spark.range(0).selectExpr("id", "'a' as part"), os.path.join(tmp, "p"), ("part",))
    assert empty.count() == 0 and read_current(spark, os.path.join(tmp, "p"), empty.schema).count() == 0
