import datetime as dt
import json
import os

from landing_helpers import landing_rows, ts
from pyspark.sql import functions as F

from farebox.schemas import LANDING_SCHEMA, MANIFEST_SCHEMA
from farebox.sources import bronze as br
from farebox.sources import inventory as inv
from farebox.sources import landing as ld


def test_inventory_inclusive_months_and_whitespace(spark):
    rows = inv.trip_file_inventory(spark, "2023-11-20", "2024-02-03", " yellow, fhvhv ", "http://x/").collect()
    assert len(rows) == 8
    first = sorted((r["year"], r["month"], r["service_type"]) for r in rows)[0]
    assert first == (2023, 11, "fhvhv")
    names = {r["filename"] for r in rows}
    assert "yellow_tripdata_2024-02.parquet" in names
    assert {r["source_url"] for r in rows if r["filename"] == "yellow_tripdata_2024-02.parquet"} == {
        "http://x/yellow_tripdata_2024-02.parquet"}
    assert inv.trip_file_inventory(spark, "2024-03-01", "2024-02-01", "yellow").count() == 0


def test_parse_file_identity(spark):
    df = spark.createDataFrame([("fhvhv_tripdata_2019-02.parquet",), ("hvfhv_tripdata_2020-12.parquet",),
                                ("readme.txt",)], "f string")
    got = [tuple(r) for r in df.select(inv.parse_file_identity("f").alias("i")).select("i.*").collect()]
    assert got == [("fhvhv", 2019, 2), ("fhvhv", 2020, 12), (None, None, None)]


def _manifest(spark, rows):
    base = dict(file_id=0, source_kind="tlc", service_type="yellow", year=2024, month=1,
                filename="yellow_tripdata_2024-01.parquet", source_url="u", size_bytes=1, sha256="a",
                row_count=1, status="DOWNLOADED", first_run_id="r1", last_run_id="r1", updated_at=None)
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in MANIFEST_SCHEMA.fields) for r in rows],
                                 MANIFEST_SCHEMA)


def test_upsert_manifest_keeps_first_run_and_id(spark):
    existing = _manifest(spark, [dict(file_id=7)])
    new = _manifest(spark, [dict(sha256="b", status="VALIDATED", first_run_id="r2", last_run_id="r2", size_bytes=9),
                            dict(month=2, filename="yellow_tripdata_2024-02.parquet", first_run_id="r2",
                                 last_run_id="r2")])
    out = {r["month"]: r for r in ld.upsert_manifest(new, existing).collect()}
    assert out[1]["file_id"] == 7 and out[1]["first_run_id"] == "r1" and out[1]["last_run_id"] == "r2"
    assert out[1]["sha256"] == "b" and out[1]["status"] == "VALIDATED" and out[1]["size_bytes"] == 9
    assert out[2]["file_id"] == 8 and out[2]["first_run_id"] == "r2"
    pend = inv.pending_files(inv.trip_file_inventory(spark, "2024-01-01", "2024-03-01", "yellow"),
                             ld.upsert_manifest(new, existing)).collect()
    assert sorted(r["month"] for r in pend) == [2, 3]
    cov = inv.bronze_coverage(ld.upsert_manifest(new, existing)).collect()
    assert [(r["service_type"], r["files"], r["bytes"]) for r in cov] == [("yellow", 1, 9)]


def test_zone_lookup_keeps_na_string(spark, tmp):
    p = os.path.join(tmp, "zones.csv")
    with open(p, "w") as fh:
        fh.write("LocationID,Borough,Zone,service_zone\n1,EWR,Newark Airport,EWR\n264,Unknown,N/A,N/A\n")
    z = ld.load_zone_lookup(spark, p).orderBy("location_id").collect()
    assert z[1]["location_id"] == 264 and z[1]["zone_name"] == "N/A" and z[1]["service_zone"] == "N/A"


def test_json_to_parquet_and_bronze_modes(spark, tmp):
    src = os.path.join(tmp, "trips.json")
    with open(src, "w") as fh:
        for r in [{"pickup_datetime": "2024-01-15 08:00:00", "dropoff_datetime": "2024-01-15 08:18:00",
                   "PULocationID": 161, "DOLocationID": 236, "trip_distance": 3.4, "total_amount": 24.5},
                  {"pickup_datetime": "2024-01-15 09:00:00", "dropoff_datetime": "2024-01-15 09:22:00",
                   "PULocationID": 236, "DOLocationID": 161, "trip_distance": 4.1, "total_amount": 29.0}]:
            fh.write(json.dumps(r) + "\n")
    assert br.json_to_parquet(spark, src, os.path.join(tmp, "out")) == 2
    empty = os.path.join(tmp, "empty.json")
    open(empty, "w").close()
    assert br.json_to_parquet(spark, empty, os.path.join(tmp, "out_empty")) == 0
    assert not os.path.exists(os.path.join(tmp, "out_empty"))
    df = spark.read.parquet(os.path.join(tmp, "out"))
    root = os.path.join(tmp, "bronze")
    path = br.write_bronze(df, root, "yellow", 2024, 1, on_conflict="ignore")
    br.write_bronze(df.limit(1), root, "yellow", 2024, 1, on_conflict="ignore")      # rerun keeps first copy
    assert spark.read.parquet(path).count() == 2
    import pytest
    with pytest.raises(Exception):
        br.write_bronze(df, root, "yellow", 2024, 1, on_conflict="fail")
    br.write_bronze(df.limit(1), root, "yellow", 2024, 1, on_conflict="replace")
    assert spark.read.parquet(path).count() == 1
    dig = br.file_digests(spark, f"{path}/*.parquet").collect()
    assert all(len(r["sha256"]) == 64 and r["size_bytes"] > 0 for r in dig)


def test_validate_and_normalize(spark, tmp):
    raw = spark.createDataFrame(
        [(dt.datetime(2024, 1, 15, 8), dt.datetime(2024, 1, 15, 8, 18), 161, 236, 3.4, 24.5)],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID long, "
        "DOLocationID long, trip_distance double, total_amount double")
    res = {r["check_name"]: r["status"] for r in
           br.validate_bronze(raw, "yellow", "yellow", 2024, 1, "yellow_tripdata_2024-01.parquet").collect()}
    assert set(res.values()) == {"PASS"} and len(res) == 9
    bad = {r["check_name"]: r["status"] for r in
           br.validate_bronze(raw.drop("DOLocationID"), "yellow", "green", 2024, 2).collect()}
    assert bad["has_dropoff_location_id"] == "FAIL" and bad["path_service_matches"] == "FAIL"
    assert bad["pickup_month_matches_path"] == "FAIL"
    p = os.path.join(tmp, "y.parquet")
    raw.write.parquet(p)
    land = br.normalize_to_landing(br.read_bronze(spark, p), "yellow", "tlc", 5, "yellow_tripdata_2024-01.parquet")
    r = land.first()
    assert land.schema.simpleString() == LANDING_SCHEMA.simpleString()
    assert r["source_row_number"] == 1 and r["pickup_location_id"] == 161 and r["total_amount"] == 24.5
    fhv = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 5), 1, 2, "B1")],
                                "pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, "
                                "PUlocationID int, DOlocationID int, dispatching_base_num string")
    f = br.normalize_to_landing(fhv.withColumn("n", F.lit(1)), "fhv", "tlc", 1, "x", row_number="n").first()
    assert f["trip_distance"] is None and f["total_amount"] is None and f["dispatching_base_num"] == "B1"
    assert f["dropoff_datetime"] == dt.datetime(2024, 1, 1, 0, 5)


def test_append_landing_is_idempotent(spark, tmp):
    rows = [dict(source_row_number=i, pickup_datetime=ts("2024-01-01 00:00:00")) for i in (1, 2, 3)]
    new = landing_rows(spark, rows)
    path = os.path.join(tmp, "landing")
    assert ld.append_landing(new.unionByName(new), path) == 3          # duplicated delivery → 3 rows
    assert ld.append_landing(new, path) == 0                           # rerun adds nothing
    more = landing_rows(spark, [dict(source_row_number=4)])
    assert ld.append_landing(more.unionByName(new), path) == 1
    assert spark.read.parquet(path).count() == 4


def test_dedupe_is_deterministic(spark):
    a = landing_rows(spark, [dict(source_row_number=1, total_amount=5.0),
                             dict(source_row_number=1, total_amount=2.0)])
    assert [r["total_amount"] for r in ld.dedupe_on_key(a).collect()] == [2.0]


def test_inventory_actions(spark):
    existing = _manifest(spark, [dict(file_id=1, status="PROCESSED")])
    inv_df = inv.trip_file_inventory(spark, "2024-01-01", "2024-02-01", "yellow")
    got = {r["month"]: r["action"] for r in inv.inventory_actions(inv_df, existing).collect()}
    assert got == {1: "SKIPPED", 2: "DOWNLOAD"}
