"""Trip fact and the zone × time × service aggregate facts.

Scale design: silver is read **once**.  ``zone_hour_partials`` reduces it to
additive sums and counts at the finest aggregate grain (date, hour, pickup
zone, service) with map-side partial aggregation, so a hot key never ships
more than one row per map task.  The hourly fact is a projection of those
partials and the daily fact is a roll-up of them (averages are re-derived from
sums and counts, so they equal a direct ``avg`` over trips).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.functions.columns import (
    average_speed_mph, date_key, hour_key, safe_div, surrogate_key)

PARTIAL_KEYS = ("pickup_date", "hour_key", "taxi_zone_key", "service_type_key")
_ADDITIVE = ("trip_count", "revenue_observation_count", "amount_sum", "duration_sum",
             "duration_n", "distance_sum", "distance_n", "speed_sum", "speed_n")


def fact_trip(trips: DataFrame) -> DataFrame:
    """One row per valid trip with date/hour keys, observed amount flag and speed."""
    return trips.select(
        "trip_id",
        date_key("pickup_datetime").alias("pickup_date_key"),
        hour_key("pickup_datetime").alias("pickup_hour_key"),
        F.col("pickup_location_id").alias("pickup_taxi_zone_key"),
        F.col("dropoff_location_id").alias("dropoff_taxi_zone_key"),
        F.col("service_type").alias("service_type_key"),
        "pickup_datetime", "dropoff_datetime", "duration_minutes", "trip_distance",
        F.col("total_amount").alias("observed_trip_amount"),
        F.col("total_amount").isNotNull().alias("has_observed_amount"),
        average_speed_mph().alias("average_speed_mph"),
        "source_kind", "source_file_id", "source_row_number",
    )


def zone_hour_partials(trips: DataFrame) -> DataFrame:
    """Additive measures per (pickup_date, hour_key, taxi_zone_key, service_type_key)."""
    t = trips.select(
        F.to_date("pickup_datetime").alias("pickup_date"),
        hour_key("pickup_datetime").alias("hour_key"),
        F.col("pickup_location_id").alias("taxi_zone_key"),
        F.col("service_type").alias("service_type_key"),
        "total_amount", "duration_minutes", "trip_distance",
        average_speed_mph().alias("speed"),
    )
    return t.groupBy(*PARTIAL_KEYS).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count("total_amount").alias("revenue_observation_count"),
        F.sum("total_amount").alias("amount_sum"),
        F.sum("duration_minutes").alias("duration_sum"),
        F.count("duration_minutes").alias("duration_n"),
        F.sum("trip_distance").alias("distance_sum"),
        F.count("trip_distance").alias("distance_n"),
        F.sum("speed").alias("speed_sum"),
        F.count("speed").alias("speed_n"),
    )


def _measures() -> list:
    return [
        F.col("trip_count").cast("long").alias("trip_count"),
        F.col("revenue_observation_count").cast("long").alias("revenue_observation_count"),
        F.col("amount_sum").alias("observed_trip_amount"),
        safe_div("duration_sum", "duration_n").alias("average_duration_minutes"),
        safe_div("distance_sum", "distance_n").alias("average_trip_distance"),
        safe_div("speed_sum", "speed_n").alias("average_speed_mph"),
        (F.col("duration_sum") / F.lit(60.0)).alias("occupied_hours"),
    ]


def fact_zone_hourly_demand(partials: DataFrame) -> DataFrame:
    """Observed (date, hour, zone, service) cells — no zero rows."""
    return partials.select(
        surrogate_key(F.col("pickup_date").cast("string"), "hour_key", "taxi_zone_key",
                      "service_type_key").alias("zone_hour_service_key"),
        date_key("pickup_date").alias("date_key"),
        "hour_key", "taxi_zone_key", "service_type_key",
        *_measures(),
    )


def fact_zone_daily_performance(partials: DataFrame) -> DataFrame:
    """(date, zone, service) roll-up of the hourly partials."""
    daily = partials.groupBy("pickup_date", "taxi_zone_key", "service_type_key").agg(
        *[F.sum(c).alias(c) for c in _ADDITIVE])
    return daily.select(
        surrogate_key(F.col("pickup_date").cast("string"), "taxi_zone_key",
                      "service_type_key").alias("zone_day_service_key"),
        date_key("pickup_date").alias("date_key"),
        "taxi_zone_key", "service_type_key",
        *_measures(),
    )


def hourly_and_daily(trips: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both aggregate facts from a single pass over ``trips``."""
    partials = zone_hour_partials(trips)
    return fact_zone_hourly_demand(partials), fact_zone_daily_performance(partials)
