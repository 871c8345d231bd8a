"""Dimension generators: date, time (hour), service type, taxi zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.columns import date_key
from farebox.schemas import DAY_PERIODS, SERVICE_ROWS

DIM_SERVICE_SCHEMA = T.StructType([
    T.StructField("service_type_key", T.StringType(), False),
    T.StructField("service_type_name", T.StringType(), False),
    T.StructField("supports_distance", T.BooleanType(), False),
    T.StructField("supports_observed_amount", T.BooleanType(), False),
])


def dim_date_from_dates(dates: DataFrame, date_col: str = "pickup_date") -> DataFrame:
    """Every day between the min and max of ``date_col``; 0 rows when it is empty/NULL.

    The bounds are one global partial aggregation (one row); the calendar is then
    generated with ``sequence``, so its size is the date span, not the data size.
    """
    bounds = dates.agg(F.min(date_col).alias("first_date"), F.max(date_col).alias("last_date"))
    days = bounds.filter(F.col("first_date").isNotNull()).select(
        F.explode(F.sequence("first_date", "last_date", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    d = F.col("full_date")
    iso_dow = (F.weekday(d) + 1).cast("short")
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("short").alias("year"),
        F.quarter(d).cast("short").alias("quarter"),
        F.month(d).cast("short").alias("month"),
        F.dayofmonth(d).cast("short").alias("day_of_month"),
        iso_dow.alias("iso_day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("short").alias("iso_week"),
        iso_dow.isin(6, 7).alias("is_weekend"),
    )


def dim_date(trips: DataFrame) -> DataFrame:
    """Calendar over the pickup dates of silver trips (pickup only, not dropoff)."""
    return dim_date_from_dates(
        trips.select(F.to_date("pickup_datetime").alias("pickup_date")), "pickup_date")


def dim_time(spark: SparkSession) -> DataFrame:
    """24 hours with label and operating day period."""
    h = F.col("id")
    period = None
    for name, first, last in DAY_PERIODS:
        cond = h.between(first, last)
        period = F.when(cond, name) if period is None else period.when(cond, name)
    padded = F.lpad(h.cast("string"), 2, "0")
    return spark.range(0, 24, numPartitions=1).select(
        h.cast("short").alias("hour_key"),
        F.concat(padded, F.lit(":00:00")).alias("hour_start"),
        F.concat(padded, F.lit(":00")).alias("hour_label"),
        period.alias("day_period"),
    )


def dim_service_type(spark: SparkSession) -> DataFrame:
    """The four supported services (literal rows, generated JVM-side)."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(f.name) for v, f in zip(row, DIM_SERVICE_SCHEMA.fields)])
                     for row in SERVICE_ROWS])
    return spark.range(1, numPartitions=1).select(F.inline(rows))


def dim_taxi_zone(zone_lookup: DataFrame) -> DataFrame:
    """Zone dimension from the zone seed (location_id → taxi_zone_key)."""
    return zone_lookup.select(
        F.col("location_id").alias("taxi_zone_key"), "borough", "zone_name", "service_zone")
