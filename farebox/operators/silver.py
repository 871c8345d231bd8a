"""Staging and silver layers (narrow transformations only — no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import duration_minutes, invalid_reason, trip_id

STAGING_COLUMNS = (
    "trip_id", "source_kind", "source_file_id", "source_filename", "source_row_number",
    "service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "trip_distance", "total_amount", "dispatching_base_num",
    "hvfhs_license_num", "duration_minutes", "loaded_at", "invalid_reason",
)

SILVER_COLUMNS = (
    "trip_id", "source_kind", "source_file_id", "source_filename", "source_row_number",
    "service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "trip_distance", "total_amount", "duration_minutes",
    "dispatching_base_num", "hvfhs_license_num", "loaded_at",
)


def stg_trip_records(landing: DataFrame) -> DataFrame:
    """Surrogate key, duration and the quarantine reason on every landing row."""
    return landing.select(
        trip_id().alias("trip_id"),
        "source_kind", "source_file_id", "source_filename", "source_row_number",
        "service_type", "pickup_datetime", "dropoff_datetime",
        "pickup_location_id", "dropoff_location_id", "trip_distance", "total_amount",
        "dispatching_base_num", "hvfhs_license_num",
        duration_minutes().alias("duration_minutes"),
        "loaded_at",
        invalid_reason().alias("invalid_reason"),
    )


def silver_trips(stg: DataFrame) -> DataFrame:
    """Valid trips: ``invalid_reason IS NULL``, 16 columns."""
    return stg.filter(F.col("invalid_reason").isNull()).select(*SILVER_COLUMNS)


def trip_quarantine(stg: DataFrame) -> DataFrame:
    """Rejected rows with their reason and the quarantine time."""
    return stg.filter(F.col("invalid_reason").isNotNull()).withColumn(
        "quarantined_at", F.current_timestamp())


def split_silver(landing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine) from one staging expression."""
    stg = stg_trip_records(landing)
    return silver_trips(stg), trip_quarantine(stg)
