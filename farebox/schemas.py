"""Fixed contracts: the landing schema, the service catalogue and rule constants."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's) -------------------------------
# Supported services, in catalogue order (the order also defines the model's
# service code: yellow=0, green=1, fhv=2, fhvhv=3).
SERVICES = ("yellow", "green", "fhv", "fhvhv")

# Service dimension rows: key, display name, supports_distance, supports_observed_amount.
SERVICE_ROWS = (
    ("yellow", "Yellow Taxi", True, True),
    ("green", "Green Taxi", True, True),
    ("fhv", "For-Hire Vehicle", False, False),
    ("fhvhv", "High Volume For-Hire Vehicle", True, True),
)

# Valid taxi zone ids are 1..265 inclusive.
MIN_ZONE_ID = 1
MAX_ZONE_ID = 265

# Quarantine reasons in precedence order (first match wins).
INVALID_REASONS = (
    "missing_pickup_datetime",
    "missing_dropoff_datetime",
    "dropoff_before_pickup",
    "missing_pickup_location",
    "missing_dropoff_location",
    "invalid_pickup_location",
    "invalid_dropoff_location",
    "negative_trip_distance",
    "negative_total_amount",
)

# Day periods of the hour dimension: (name, first hour, last hour).
DAY_PERIODS = (
    ("overnight", 0, 5),
    ("morning_peak", 6, 9),
    ("midday", 10, 15),
    ("evening_peak", 16, 19),
    ("night", 20, 23),
)

# Default profitability scenario.
DEFAULT_SCENARIO = {
    "commission_rate": 0.20,
    "variable_cost_per_mile": 0.35,
    "fixed_cost_per_trip": 1.50,
}

# Control-table vocabularies.
SOURCE_KINDS = ("demo", "tlc")
RUN_MODES = ("demo", "full")
RUN_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED")
TASK_STATUSES = ("RUNNING", "SUCCEEDED", "FAILED", "SKIPPED")
FILE_STATUSES = ("DISCOVERED", "DOWNLOADING", "DOWNLOADED", "VALIDATED",
                 "PROCESSED", "FAILED", "QUARANTINED")
QUALITY_STATUSES = ("PASS", "FAIL", "WARN")
ORCHESTRATORS = ("python", "nifi")
FORECAST_HORIZONS = (1, 24)
DEFAULT_BASE_URL = "https://d37ci6vzurychx.cloudfront.net/trip-data"
# -----------------------------------------------------------------------------

LANDING_KEY = ("source_kind", "source_file_id", "source_row_number")
MANIFEST_KEY = ("source_kind", "service_type", "year", "month", "filename")

LANDING_SCHEMA = T.StructType([
    T.StructField("source_kind", T.StringType(), False),
    T.StructField("source_file_id", T.LongType(), False),
    T.StructField("source_filename", T.StringType(), False),
    T.StructField("source_row_number", T.LongType(), False),
    T.StructField("service_type", T.StringType(), False),
    T.StructField("pickup_datetime", T.TimestampNTZType(), True),
    T.StructField("dropoff_datetime", T.TimestampNTZType(), True),
    T.StructField("pickup_location_id", T.IntegerType(), True),
    T.StructField("dropoff_location_id", T.IntegerType(), True),
    T.StructField("trip_distance", T.DoubleType(), True),
    T.StructField("total_amount", T.DoubleType(), True),
    T.StructField("dispatching_base_num", T.StringType(), True),
    T.StructField("hvfhs_license_num", T.StringType(), True),
    T.StructField("loaded_at", T.TimestampType(), False),
])

ZONE_LOOKUP_SCHEMA = T.StructType([
    T.StructField("location_id", T.IntegerType(), True),
    T.StructField("borough", T.StringType(), True),
    T.StructField("zone_name", T.StringType(), True),
    T.StructField("service_zone", T.StringType(), True),
])

MANIFEST_SCHEMA = T.StructType([
    T.StructField("file_id", T.LongType(), False),
    T.StructField("source_kind", T.StringType(), False),
    T.StructField("service_type", T.StringType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("source_url", T.StringType(), False),
    T.StructField("size_bytes", T.LongType(), True),
    T.StructField("sha256", T.StringType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("first_run_id", T.StringType(), False),
    T.StructField("last_run_id", T.StringType(), False),
    T.StructField("updated_at", T.TimestampType(), True),
])
