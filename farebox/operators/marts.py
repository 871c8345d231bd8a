"""Business marts on the gold facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.columns import safe_div
from farebox.schemas import DEFAULT_SCENARIO

def _zones(zone_dim: DataFrame) -> DataFrame:
    """Spark broadcasts the dimension when its statistics, or adaptive execution, prove it small."""
    return zone_dim.select("taxi_zone_key", "borough", "zone_name")


def mart_driver_opportunity(hourly: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Observed amount per occupied hour and demand relative to the busiest zone.

    The window partition (date, hour, service) holds at most one row per zone,
    so no window group can grow with trip volume.
    """
    w = Window.partitionBy("date_key", "hour_key", "service_type_key")
    return hourly.join(_zones(zone_dim), "taxi_zone_key").select(
        "zone_hour_service_key", "date_key", "hour_key", "taxi_zone_key", "borough",
        "zone_name", "service_type_key", "trip_count", "observed_trip_amount",
        "occupied_hours",
        safe_div("observed_trip_amount", "occupied_hours").alias("observed_amount_per_occupied_hour"),
        safe_div(F.lit(100.0) * F.col("trip_count"), F.max("trip_count").over(w))
        .alias("relative_demand_score"),
    )


def mart_congestion_proxy(hourly: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Speed and minutes-per-mile proxies per zone-hour."""
    return hourly.join(_zones(zone_dim), "taxi_zone_key").select(
        "zone_hour_service_key", "date_key", "hour_key", "taxi_zone_key", "borough",
        "zone_name", "service_type_key", "trip_count", "average_duration_minutes",
        "average_trip_distance", "average_speed_mph",
        F.when(F.col("average_trip_distance") > 0,
               F.col("average_duration_minutes") / F.col("average_trip_distance"))
        .alias("minutes_per_mile_proxy"),
    )


def mart_profitability_scenario(daily: DataFrame, zone_dim: DataFrame,
                                commission_rate: float = DEFAULT_SCENARIO["commission_rate"],
                                variable_cost_per_mile: float = DEFAULT_SCENARIO["variable_cost_per_mile"],
                                fixed_cost_per_trip: float = DEFAULT_SCENARIO["fixed_cost_per_trip"],
                                ) -> DataFrame:
    """Estimated net contribution under a configurable cost scenario (not observed profit)."""
    amt, n = F.col("observed_trip_amount"), F.col("trip_count")
    dist = F.coalesce(F.col("average_trip_distance"), F.lit(0.0))
    net = (amt - amt * F.lit(float(commission_rate))
           - dist * n * F.lit(float(variable_cost_per_mile))
           - n * F.lit(float(fixed_cost_per_trip)))
    return daily.join(_zones(zone_dim), "taxi_zone_key").select(
        "zone_day_service_key", "date_key", "taxi_zone_key", "borough", "zone_name",
        "service_type_key", "trip_count", "revenue_observation_count",
        "observed_trip_amount", "average_trip_distance",
        F.lit(str(commission_rate)).cast("decimal(10,4)").alias("assumed_commission_rate"),
        F.lit(str(variable_cost_per_mile)).cast("decimal(10,4)").alias("assumed_variable_cost_per_mile"),
        F.lit(str(fixed_cost_per_trip)).cast("decimal(10,4)").alias("assumed_fixed_cost_per_trip"),
        F.when(F.col("revenue_observation_count") > 0, net).alias("estimated_net_contribution_scenario"),
    )


def mart_mobility_overview(daily: DataFrame, service_dim: DataFrame) -> DataFrame:
    """Daily totals per service.

    ``active_pickup_zones`` counts daily rows: the daily fact is unique on
    (date, zone, service) and its zone is never NULL, so ``count(zone)`` equals
    ``count(DISTINCT zone)`` without the extra Expand/shuffle a distinct needs.
    """
    n = F.col("trip_count")
    d = daily.join(service_dim.select("service_type_key", "service_type_name"), "service_type_key")
    return d.groupBy("date_key", "service_type_key", "service_type_name").agg(
        F.sum(n).cast("long").alias("trip_count"),
        F.count("taxi_zone_key").cast("int").alias("active_pickup_zones"),
        F.sum("revenue_observation_count").cast("long").alias("revenue_observation_count"),
        F.sum("observed_trip_amount").alias("observed_trip_amount"),
        F.sum("occupied_hours").alias("occupied_hours"),
        safe_div(F.sum(F.col("average_duration_minutes") * n), F.sum(n))
        .alias("weighted_average_duration_minutes"),
        safe_div(F.sum(F.col("average_trip_distance") * n),
                 F.sum(F.when(F.col("average_trip_distance").isNotNull(), n)))
        .alias("weighted_average_trip_distance"),
    )


def mart_service_comparison(service_dim: DataFrame, daily: DataFrame) -> DataFrame:
    """Cumulative comparison per service; services without trips are kept.

    The daily fact is aggregated per service *before* the left join, so the
    join sees at most one row per service and distinct counts stay exact.
    """
    per_service = daily.groupBy("service_type_key").agg(
        F.sum("trip_count").cast("long").alias("trip_count"),
        F.count_distinct("date_key").cast("int").alias("active_days"),
        F.count_distinct("taxi_zone_key").cast("int").alias("active_pickup_zones"),
        F.sum("revenue_observation_count").cast("long").alias("revenue_observation_count"),
        F.sum("observed_trip_amount").alias("observed_trip_amount"),
        F.sum("occupied_hours").alias("occupied_hours"),
    )
    s = service_dim.select("service_type_key", "service_type_name")
    return s.join(per_service, "service_type_key", "left").select(
        "service_type_key", "service_type_name", "trip_count",
        F.coalesce("active_days", F.lit(0)).alias("active_days"),
        F.coalesce("active_pickup_zones", F.lit(0)).alias("active_pickup_zones"),
        "revenue_observation_count", "observed_trip_amount", "occupied_hours",
        safe_div("observed_trip_amount", "revenue_observation_count")
        .alias("observed_amount_per_priced_trip"),
    )
