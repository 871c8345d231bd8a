"""Files of many schemas, content identity, and file states."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from farebox.sources import file_states as fs
from farebox.sources import files as fl
from farebox.sources import inventory as inv
from farebox.streaming.ingest import ingest_files, ingest_landing_stream

T = dt.datetime(2024, 1, 15, 8)
OLD = "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID long, DOLocationID long, trip_distance double, total_amount double"
NEW = "PICKUP_DATETIME string, dropoff_datetime string, pickup_location_id double, dropoff_location_id int, total_amount string, extra int"


def put(df, root, name, service="yellow", year=2024, month=1):
    """One Parquet file under a name of its own."""
    folder = os.path.join(root, service, f"year={year:04d}", f"month={month:02d}")
    tmp = os.path.join(root, "..", f"write-{name}")
    df.coalesce(1).write.parquet(tmp)
    os.makedirs(folder, exist_ok=True)
    part = next(f for f in os.listdir(tmp) if f.startswith("part-"))
    return shutil.copy(os.path.join(tmp, part), os.path.join(folder, name))


def old(spark, n=3):
    return spark.createDataFrame([(T, T + dt.timedelta(minutes=k), 161, 236, 3.4, 24.5) for k in range(n)], OLD)


def new(spark):
    return spark.createDataFrame([("2024-01-20 10:00:00", "2024-01-20 10:30:00", 7.0, 9, "12.25", 1), ("not a time", None, None, None, "n/a", 1)], NEW)


def bronze(spark, tmp):
    """Two schemas, one of them twice under two names, an unreadable, an empty and a missing-column file."""
    root = os.path.join(tmp, "bronze")
    put(old(spark), root, "yellow_tripdata_2024-01.parquet")
    put(new(spark), root, "yellow_tripdata_2024-01_late.parquet")
    folder = os.path.join(root, "yellow", "year=2024", "month=01")
    shutil.copy(os.path.join(folder, "yellow_tripdata_2024-01.parquet"), os.path.join(folder, "again.parquet"))
    with open(os.path.join(folder, "broken.parquet"), "wb") as f:
        f.write(b"PAR1 this is no footer PAR1")
    open(os.path.join(folder, "nothing.parquet"), "wb").close()
    put(old(spark).limit(0), root, "green_tripdata_2024-01.parquet", "green")
    put(old(spark).drop("DOLocationID"), root, "yellow_tripdata_2024-02.parquet", month=2)
    put(old(spark), root, "fhv_tripdata_2024-03.parquet", month=3)   # name and folder differ
    return root


def test_inspection_survives_unreadable_files(spark, tmp):
    seen = {r["file_name"]: r for r in fl.inspect_files(fl.list_files(spark, bronze(spark, tmp))).collect()}
    assert len(seen) == 8
    assert not seen["broken.parquet"]["readable"] and seen["broken.parquet"]["error"] and len(seen["broken.parquet"]["sha256"]) == 64
    assert not seen["nothing.parquet"]["readable"]
    a, b = seen["yellow_tripdata_2024-01.parquet"], seen["again.parquet"]
    assert a["sha256"] == b["sha256"] and a["file_id"] == b["file_id"] > 0
    assert a["schema_key"] != seen["yellow_tripdata_2024-01_late.parquet"]["schema_key"]
    assert (a["service_type"], a["year"], a["month"], a["num_rows"]) == ("yellow", 2024, 1, 3)


def test_every_file_gets_its_verdicts(spark, tmp):
    inspected = fl.inspect_files(fl.list_files(spark, bronze(spark, tmp))).checkpoint()
    got = {}
    for r in fl.validate_files(inspected, fl.pickup_months(spark, inspected)).collect():
        if r["status"] == "FAIL":
            got.setdefault(r["file_name"], set()).add(r["check_name"])
    needs = {f"has_{c}" for c in fl.REQUIRED}
    assert got == {
        "broken.parquet": {"readable", "has_rows", "has_columns", *needs},
        "nothing.parquet": {"readable", "has_rows", "has_columns", *needs},
        "green_tripdata_2024-01.parquet": {"has_rows", "has_pickup_datetime", "has_dropoff_datetime"},
        "yellow_tripdata_2024-02.parquet": {"has_dropoff_location_id"},
        "fhv_tripdata_2024-03.parquet": {"file_name_matches_path"},
    }
    wrong_month = fl.inspect_files(fl.list_files(spark, put(old(spark), os.path.join(tmp, "other"), "x.parquet", month=7)))
    verdict = fl.validate_files(wrong_month, fl.pickup_months(spark, wrong_month)).filter("status = 'FAIL'").collect()
    assert [r["check_name"] for r in verdict] == ["pickup_month_matches_path"]


def test_mixed_schemas_land_once(spark, tmp):
    root, out = bronze(spark, tmp), os.path.join(tmp, "landing")
    args = (spark, root, out, os.path.join(tmp, "ckpt"))
    assert ingest_landing_stream(*args, events_path=os.path.join(tmp, "events")) == 5
    rows = spark.read.parquet(out).orderBy("source_filename", "source_row_number").collect()
    assert len(rows) == 5 and {r["source_filename"] for r in rows} == {"again.parquet", "yellow_tripdata_2024-01_late.parquet"}
    late = [r for r in rows if r["source_filename"].endswith("late.parquet")]
    assert late[0]["pickup_datetime"] == dt.datetime(2024, 1, 20, 10) and late[0]["pickup_location_id"] == 7 and late[0]["total_amount"] == 12.25
    assert late[1]["pickup_datetime"] is None and late[1]["total_amount"] is None and late[0]["trip_distance"] is None
    # a file under a third name, and a new one: only the new one lands
    folder = os.path.join(root, "yellow", "year=2024", "month=01")
    shutil.copy(os.path.join(folder, "again.parquet"), os.path.join(folder, "third.parquet"))
    put(old(spark, 7), root, "yellow_tripdata_2024-01_more.parquet")
    assert ingest_landing_stream(*args, events_path=os.path.join(tmp, "events")) == 7
    assert ingest_landing_stream(*args) == 0
    states = {r["filename"]: r for r in fs.current_states(fs.read_events(spark, os.path.join(tmp, "events"))).collect()}
    assert states["third.parquet"]["status"] == states["again.parquet"]["status"] == "PROCESSED"
    assert states["broken.parquet"]["status"] == "QUARANTINED" and states["yellow_tripdata_2024-02.parquet"]["last_error"] == "has_dropoff_location_id"


def test_a_batch_can_be_repeated(spark, tmp):
    """As after a crash between the append and the stream's commit: a new checkpoint hands out the same files."""
    root, out = bronze(spark, tmp), os.path.join(tmp, "landing")
    assert ingest_landing_stream(spark, root, out, os.path.join(tmp, "c1"), files_a_batch=1) == 5
    assert ingest_landing_stream(spark, root, out, os.path.join(tmp, "c2")) == 0
    assert spark.read.parquet(out).count() == 5


def test_manifest_ids_are_kept(spark, tmp):
    root, out = bronze(spark, tmp), os.path.join(tmp, "landing")
    digest = next(r["sha256"] for r in fl.inspect_files(fl.list_files(spark, root)).collect() if r["file_name"] == "again.parquet")
    manifest = spark.createDataFrame([(77, digest), (78, None)], "file_id long, sha256 string")
    assert ingest_files(spark, fl.list_files(spark, root), out, manifest=manifest) == 5
    assert spark.read.parquet(out).filter("source_file_id = 77").count() == 3
    nothing = fl.list_files(spark, root).filter("length < 0")
    assert ingest_files(spark, nothing, out) == 0


def event(spark, rows):
    base = dict(source_kind="tlc", service_type="yellow", year=2024, month=1, filename="f", status="DISCOVERED", run_id="r1",
                event_at=T, sha256=None, size_bytes=None, row_count=None, error_message=None)
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in fs.EVENT_SCHEMA.fields) for r in rows], fs.EVENT_SCHEMA)


def at(minute):
    return T + dt.timedelta(minutes=minute)


def test_states_fold(spark, tmp):
    path = os.path.join(tmp, "events")
    assert fs.current_states(fs.read_events(spark, path)).collect() == []
    fs.append_events(event(spark, [dict(), dict(status="DOWNLOADING", event_at=at(1)), dict(status="FAILED", event_at=at(2), error_message="timeout")]), path)
    fs.append_events(event(spark, [dict(status="DOWNLOADING", event_at=at(5), run_id="r2"), dict(status="DOWNLOADED", event_at=at(6), run_id="r2", sha256="a", size_bytes=9),
                                   dict(status="VALIDATED", event_at=at(6), run_id="r2", row_count=4)]), path)
    r = fs.current_states(fs.read_events(spark, path)).first()
    assert (r["status"], r["retry_count"], r["last_error"], r["sha256"], r["size_bytes"], r["row_count"]) == ("VALIDATED", 1, "timeout", "a", 9, 4)
    assert (r["first_run_id"], r["last_run_id"]) == ("r1", "r2")
    assert r["last_attempt_at"] - r["created_at"] == dt.timedelta(minutes=5) and r["updated_at"] - r["created_at"] == dt.timedelta(minutes=6)


def test_what_to_fetch(spark):
    names = {m: f"yellow_tripdata_2024-{m:02d}.parquet" for m in range(1, 6)}
    rows = [dict(month=1, status="PROCESSED")] + [dict(month=2, status=s, event_at=at(k)) for k, s in enumerate(["DOWNLOADING", "FAILED"] * 4)]
    rows += [dict(month=3, status="DOWNLOADING"), dict(month=3, status="FAILED", event_at=at(1)), dict(month=4, status="DISCOVERED")]
    states = fs.current_states(event(spark, [dict(r, filename=names[r["month"]]) for r in rows]))
    got = {r["month"]: (r["action"], r["retry_count"]) for r in fs.files_to_fetch(inv.trip_file_inventory(spark, "2024-01-01", "2024-05-01", "yellow"), states).collect()}
    assert got == {1: ("SKIPPED", 0), 2: ("EXHAUSTED", 3), 3: ("RETRY", 0), 4: ("DOWNLOAD", 0), 5: ("DOWNLOAD", 0)}
