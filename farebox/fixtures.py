"""Trip-shaped inputs derived from the driver's generic test tables.

There is no trip table among the test tables, so the ``events`` table is mapped
onto the landing contract (every quarantine rule, NULL money for fhv, zero
minute trips, 11 pickup zones, 4 services), and a 265-row zone seed is derived
from ``nation`` / ``region``.  The mapping is plain projection: it scales with
``events`` and adds no shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import LANDING_SCHEMA

FIXTURE_LOADED_AT = _dt.datetime(2024, 2, 1, 0, 0, 0, tzinfo=_dt.timezone.utc)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landing_from_events(events: DataFrame) -> DataFrame:
    """Map ``events`` rows to landing rows (see FIXTURES.md §3)."""
    e = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )
    eid = F.col("event_id")
    service = (
        F.when(F.col("event_type") == "view", "fhvhv")
        .when(F.col("event_type") == "purchase", "green")
        .when(F.col("event_type") == "signup", "fhv")
        .otherwise("yellow")
    )
    file_id = (eid % 4 + 1).cast("long")
    signup = F.col("event_type") == "signup"
    out = e.select(
        F.lit("demo").alias("source_kind"),
        file_id.alias("source_file_id"),
        F.concat(service, F.lit("_tripdata_2024-01_"), file_id.cast("string")).alias("source_filename"),
        eid.cast("long").alias("source_row_number"),
        service.alias("service_type"),
        F.when(eid % 97 == 0, None).otherwise(F.col("ts")).alias("pickup_datetime"),
        F.when(eid % 89 == 0, None)
        .otherwise(F.timestamp_add("MINUTE", F.col("k") - 2, F.col("ts"))).alias("dropoff_datetime"),
        F.when(eid % 83 == 0, None)
        .otherwise((F.col("user_id") % 12).cast("int") * 22).alias("pickup_location_id"),
        F.when(eid % 79 == 0, None)
        .otherwise(((F.col("user_id") * 7 + F.col("k")) % 268).cast("int")).alias("dropoff_location_id"),
        F.when(signup, None).when(eid % 101 == 0, -F.col("value"))
        .otherwise(F.col("value") / 10).alias("trip_distance"),
        F.when(signup, None).when(eid % 103 == 0, -F.col("value"))
        .otherwise(F.col("value")).alias("total_amount"),
        F.lit(None).cast("string").alias("dispatching_base_num"),
        F.lit(None).cast("string").alias("hvfhs_license_num"),
        F.lit(FIXTURE_LOADED_AT).cast("timestamp").alias("loaded_at"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in LANDING_SCHEMA.fields])


def zone_seed_from_nations(spark: SparkSession, nation: DataFrame, region: DataFrame) -> DataFrame:
    """265-row zone seed in the seed CSV's shape (location_id, borough, zone_name, service_zone)."""
    ids = spark.range(1, 266).select(F.col("id").cast("int").alias("location_id"))
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    # no broadcast hint: Spark's own size statistics of the two small tables
    # decide the join strategy (autoBroadcastJoinThreshold)
    return (
        ids.join(n, F.col("location_id") % 25 == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "location_id",
            F.col("r_name").alias("borough"),
            F.concat(F.col("n_name"), F.lit("-"), F.col("location_id").cast("string")).alias("zone_name"),
            F.when(F.col("location_id") % 3 == 0, "Yellow Zone")
            .when(F.col("location_id") % 3 == 1, "Boro Zone")
            .otherwise("Airports").alias("service_zone"),
        )
    )


def fixture_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(landing, zone_seed) for one scale-factor folder."""
    landing = landing_from_events(read_table(spark, sf_dir, "events"))
    zones = zone_seed_from_nations(spark, read_table(spark, sf_dir, "nation"),
                                   read_table(spark, sf_dir, "region"))
    return landing, zones


# --- control-table fixtures derived from the landing rows ---------------------------
FIXTURE_SPLIT_TS = "2024-01-16 00:00:00"   # rows picked up before this landed in run 1


def inventory_requests(landing: DataFrame) -> DataFrame:
    """One request spanning the landed pickup months plus two months ahead,
    over the services present in the data."""
    return landing.agg(
        F.min("pickup_datetime").alias("start_date"),
        F.add_months(F.max("pickup_datetime"), 2).alias("end_date"),
        F.concat_ws(",", F.sort_array(F.collect_set("service_type"))).alias("services"),
    )


def monthly_file_manifest(landing: DataFrame, status: str, run_id: str,
                          base_url: str) -> DataFrame:
    """Manifest rows for the monthly files the landed trips came from
    (service × pickup month), named as the inventory names them."""
    from farebox.schemas import MANIFEST_SCHEMA
    rows = landing.filter(F.col("pickup_datetime").isNotNull()).select(
        "service_type", F.year("pickup_datetime").alias("y"), F.month("pickup_datetime").alias("m"))
    g = rows.groupBy("service_type", "y", "m").agg(F.count(F.lit(1)).alias("n"))
    fname = F.format_string("%s_tripdata_%04d-%02d.parquet", F.col("service_type"), F.col("y"), F.col("m"))
    out = g.select(
        F.lit(0).cast("long").alias("file_id"),
        F.lit("tlc").alias("source_kind"), "service_type",
        F.col("y").cast("short").alias("year"), F.col("m").cast("short").alias("month"),
        fname.alias("filename"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), fname).alias("source_url"),
        (F.col("n") * 100).cast("long").alias("size_bytes"),
        F.sha2(F.concat_ws("|", fname, F.col("n").cast("string")), 256).alias("sha256"),
        F.col("n").cast("long").alias("row_count"),
        F.lit(status).alias("status"),
        F.lit(run_id).alias("first_run_id"), F.lit(run_id).alias("last_run_id"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )
    return out.select([F.col(f.name).cast(f.dataType) for f in MANIFEST_SCHEMA.fields])


def daily_file_events(landing: DataFrame) -> DataFrame:
    """File events of one made-up file a service and pickup day with n trips: 1 + n % 4
    attempts an hour apart from the day's first pickup on, all but the last failed; the
    last one fails too where n % 5 = 0, else it goes on to PROCESSED."""
    days = landing.filter("pickup_datetime IS NOT NULL").groupBy("service_type", F.to_date("pickup_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.min("pickup_datetime").cast("timestamp").alias("first_at"))
    tries = days.select("*", F.explode(F.sequence(F.lit(0), (F.col("n") % 4).cast("int"))).alias("k"))
    ok = (F.col("k") == F.col("n") % 4) & (F.col("n") % 5 != 0)
    step = lambda status, minute: F.struct(F.lit(status).alias("status"), F.lit(minute).alias("minute"))
    steps = F.when(ok, F.array(step("DOWNLOADING", 0), step("DOWNLOADED", 20), step("VALIDATED", 30), step("PROCESSED", 40))) \
        .otherwise(F.array(step("DOWNLOADING", 0), step("FAILED", 10)))
    e = tries.select("*", F.inline(steps))
    done = F.col("status").isin("DOWNLOADED", "VALIDATED", "PROCESSED")
    return e.select(
        F.lit("tlc").alias("source_kind"), "service_type", F.year("day").cast("short").alias("year"), F.month("day").cast("short").alias("month"),
        F.concat("service_type", F.lit("_tripdata_"), F.date_format("day", "yyyy-MM-dd"), F.lit(".parquet")).alias("filename"), "status",
        F.concat(F.lit("run-"), F.col("k")).alias("run_id"),
        (F.col("first_at") + F.make_dt_interval(hours=F.col("k"), mins=F.col("minute"))).alias("event_at"),
        F.when(done, F.sha2(F.concat_ws("|", "service_type", F.col("day").cast("string"), F.col("n").cast("string")), 256)).alias("sha256"),
        F.when(done, F.col("n") * 100).alias("size_bytes"), F.when(F.col("status") == "PROCESSED", F.col("n")).alias("row_count"),
        F.when(F.col("status") == "FAILED", F.concat(F.lit("attempt "), F.col("k"))).alias("error_message"))


def daily_run_records(landing: DataFrame) -> DataFrame:
    """Append-only run records of one run a pickup day: RUNNING at its first pickup; where the day's
    number isn't a multiple of 5, a last record at its last pickup, FAILED where it is one of 3."""
    days = landing.filter("pickup_datetime IS NOT NULL").groupBy(F.to_date("pickup_datetime").alias("day")).agg(
        F.min("pickup_datetime").cast("timestamp").alias("a"), F.max("pickup_datetime").cast("timestamp").alias("b"))
    number = F.dayofmonth("day")
    record = lambda status, at: F.struct(status.alias("status"), at.alias("recorded_at"))
    running = record(F.lit("RUNNING"), F.col("a"))
    last = record(F.when(number % 3 == 0, "FAILED").otherwise("SUCCEEDED"), F.col("b"))
    run = F.concat(F.lit("run-"), F.date_format("day", "yyyyMMdd"))
    return days.select(run.alias("run_id"), F.lit("python").alias("orchestrator"), F.lit("full").alias("mode"),
                       F.inline(F.when(number % 5 == 0, F.array(running)).otherwise(F.array(running, last))))
