"""Second-tier analytics named by the warehouse's documentation: unit
economics, flows between boroughs, origin/destination rankings, demand
profiles, period comparison, data-quality profile, file/month coherence,
scenario grid and break-even, calendar enrichment.

Every function aggregates *before* joining the small dimensions, so the wide
trip-level side is reduced with map-side partial aggregation first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.functions.columns import date_of_key, day_period, safe_div
from farebox.session import checkpoint_dir



def kpi_unit_economics(trips: DataFrame, by: tuple[str, ...] = ("service_type",)) -> DataFrame:
    """Observed amount per priced trip, per mile and per occupied hour, with sample sizes."""
    amt, dist, dur = F.col("total_amount"), F.col("trip_distance"), F.col("duration_minutes")
    priced_with_miles = amt.isNotNull() & (dist > 0)
    return trips.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.count(amt).alias("priced_trip_count"),
        safe_div(F.sum(amt), F.count(amt)).alias("amount_per_priced_trip"),
        F.count(F.when(priced_with_miles, 1)).alias("priced_trips_with_distance"),
        safe_div(F.sum(F.when(priced_with_miles, amt)), F.sum(F.when(priced_with_miles, dist)))
        .alias("amount_per_mile"),
        safe_div(F.sum(F.when(amt.isNotNull(), amt)), F.sum(F.when(amt.isNotNull(), dur)) / F.lit(60.0))
        .alias("amount_per_occupied_hour"),
    )


def _zone_pairs(fact_trip: DataFrame) -> DataFrame:
    return fact_trip.groupBy("pickup_taxi_zone_key", "dropoff_taxi_zone_key").agg(
        F.count(F.lit(1)).alias("trip_count"))


def borough_flows(fact_trip: DataFrame, zone_dim: DataFrame) -> DataFrame:
    """Trips between pickup and dropoff boroughs (pairs aggregated first: ≤ zones² rows)."""
    z = zone_dim.select("taxi_zone_key", "borough")
    pairs = _zone_pairs(fact_trip)
    j = (pairs.join(z.withColumnRenamed("taxi_zone_key", "pickup_taxi_zone_key")
                    .withColumnRenamed("borough", "pickup_borough"), "pickup_taxi_zone_key")
         .join(z.withColumnRenamed("taxi_zone_key", "dropoff_taxi_zone_key")
               .withColumnRenamed("borough", "dropoff_borough"), "dropoff_taxi_zone_key"))
    return j.groupBy("pickup_borough", "dropoff_borough").agg(
        F.sum("trip_count").cast("long").alias("trip_count")).withColumn(
        "cross_borough", F.col("pickup_borough") != F.col("dropoff_borough"))


def od_pairs_top(fact_trip: DataFrame, zone_dim: DataFrame, k: int = 20) -> DataFrame:
    """The k busiest (pickup zone, dropoff zone) pairs; ties by zone keys."""
    z = zone_dim.select("taxi_zone_key", "zone_name")
    top = _zone_pairs(fact_trip).orderBy(F.desc("trip_count"), "pickup_taxi_zone_key",
                                         "dropoff_taxi_zone_key").limit(k)
    return (top.join(z.withColumnRenamed("taxi_zone_key", "pickup_taxi_zone_key")
                     .withColumnRenamed("zone_name", "pickup_zone_name"), "pickup_taxi_zone_key", "left")
            .join(z.withColumnRenamed("taxi_zone_key", "dropoff_taxi_zone_key")
                  .withColumnRenamed("zone_name", "dropoff_zone_name"), "dropoff_taxi_zone_key", "left"))


def zone_ranking(fact_trip: DataFrame, side: str = "pickup", k: int | None = None) -> DataFrame:
    """Zones ranked by trips per service (dense rank); ``k`` keeps the top-k ranks.

    The ranking window partitions by service over one row per zone, so it is
    bounded by the number of zones.
    """
    key = f"{side}_taxi_zone_key"
    counts = fact_trip.groupBy("service_type_key", key).agg(F.count(F.lit(1)).alias("trip_count"))
    w = Window.partitionBy("service_type_key").orderBy(F.desc("trip_count"))
    ranked = counts.withColumn("zone_rank", F.dense_rank().over(w)).withColumnRenamed(key, "taxi_zone_key")
    return ranked.filter(F.col("zone_rank") <= k) if k else ranked


def demand_profile(hourly: DataFrame, by: str) -> DataFrame:
    """Trips per (service, group) and an index = group mean per cell ÷ service mean per cell.

    ``by``: 'day_period' | 'hour_key' | 'weekend' | 'month'.  Date and hour
    attributes follow from the keys, so the fact is read alone, once.
    """
    group = {"day_period": day_period("hour_key"), "hour_key": F.col("hour_key"),
             "weekend": F.when(F.weekday(date_of_key("date_key")) >= 5, "weekend").otherwise("weekday"),
             "month": F.month(date_of_key("date_key")).cast("short")}[by]
    g = hourly.groupBy("service_type_key", group.alias(by)).agg(
        F.sum("trip_count").cast("long").alias("trip_count"),
        F.count(F.lit(1)).alias("observed_cells"))
    w = Window.partitionBy("service_type_key")
    mean_cell = F.col("trip_count") / F.col("observed_cells")
    overall = F.sum("trip_count").over(w) / F.sum("observed_cells").over(w)
    return g.withColumn("trips_per_cell", mean_cell).withColumn("demand_index", mean_cell / overall)


# --- fixed values: analysis periods (first year, last year) ----------------------
PERIODS = (("2018_2019", 2018, 2019), ("2020_2021", 2020, 2021), ("2022_2025", 2022, 2025))
# ---------------------------------------------------------------------------------


def period_comparison(daily: DataFrame) -> DataFrame:
    """Totals per service and period bucket (years outside the buckets → 'other')."""
    year = (F.col("date_key") / 10000).cast("int")
    period = None
    for name, a, b in PERIODS:
        period = F.when(year.between(a, b), name) if period is None else period.when(year.between(a, b), name)
    period = period.otherwise("other")
    n = F.col("trip_count")
    return daily.groupBy("service_type_key", period.alias("period")).agg(
        F.sum(n).cast("long").alias("trip_count"),
        F.count_distinct("date_key").cast("int").alias("active_days"),
        F.sum("observed_trip_amount").alias("observed_trip_amount"),
        safe_div(F.sum(F.col("average_duration_minutes") * n), F.sum(n)).alias("weighted_average_duration_minutes"),
    ).withColumn("trips_per_day", safe_div("trip_count", "active_days"))


def quality_profile(stg: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per column: rows, NULLs, NULL share, and min/max for numeric columns — one pass.

    An inspection signal only; nothing is filtered.
    """
    numeric = {"int", "bigint", "smallint", "double", "float"}
    types = dict(stg.dtypes)
    cols = columns or [c for c in stg.columns if c not in ("trip_id", "loaded_at", "invalid_reason")]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        num = types[c] in numeric
        aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"n{i}"),
                 (F.min(c).cast("double") if num else F.lit(None).cast("double")).alias(f"lo{i}"),
                 (F.max(c).cast("double") if num else F.lit(None).cast("double")).alias(f"hi{i}")]
    row = stg.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("null_count"),
                        F.col(f"lo{i}").alias("min_value"), F.col(f"hi{i}").alias("max_value"))
               for i, c in enumerate(cols)]
    out = row.select("rows", F.explode(F.array(*structs)).alias("s")).select("rows", "s.*")
    return out.select("column_name", "rows", "null_count",
                      safe_div(F.col("null_count") * F.lit(100.0), F.col("rows")).alias("null_pct"),
                      "min_value", "max_value")


def quality_percentiles(stg: DataFrame, columns: tuple[str, ...] = ("trip_distance", "total_amount",
                                                                      "duration_minutes"),
                        probs: tuple[float, ...] = (0.01, 0.5, 0.99)) -> DataFrame:
    """Exact percentiles per numeric column: the smallest value with at least the
    share ``p`` of the non-NULL values at or below it (discrete percentile).

    Values are counted first (map-side combine), so a value that a third of all
    rows share is one row.  The distinct values are dealt to partitions by range,
    which follows their number and not their size, so an outlier moves nothing.
    One row a partition gives the offsets, and ranks are computed only in the
    partitions that hold a percentile.
    """
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v"))
                                  for c in columns])).alias("s")
    counts = (stg.select(stacked).select("s.*").filter(F.col("v").isNotNull())
              .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n")))
    checkpoint_dir(stg.sparkSession)
    # stored, as the sampled range bounds may differ from one evaluation to the next
    dealt = counts.repartitionByRange("column_name", "v").withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    parts = dealt.groupBy("column_name", "part").agg(F.sum("n").alias("m"))
    by_part = Window.partitionBy("column_name").orderBy("part")
    asked = F.explode(F.array(*(F.lit(p) for p in probs))).alias("probability")
    hit = (parts.select("column_name", "part", (F.sum("m").over(by_part) - F.col("m")).alias("before"), "m",
                        F.sum("m").over(Window.partitionBy("column_name")).alias("total"))
           .select("*", asked).withColumn("rank", F.ceil(F.col("probability") * F.col("total")))
           .filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("m"))))
    inside = dealt.join(hit.select("column_name", "part").distinct(), ["column_name", "part"], "left_semi")
    ranked = inside.withColumn("upto", F.sum("n").over(Window.partitionBy("column_name", "part").orderBy("v")))
    return (hit.join(ranked, ["column_name", "part"]).filter(F.col("before") + F.col("upto") >= F.col("rank"))
            .groupBy("column_name", "probability").agg(F.min("v").alias("percentile")))


def valid_share(stg: DataFrame, by: tuple[str, ...] = ("service_type",)) -> DataFrame:
    return stg.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(F.col("invalid_reason").isNull(), 1)).alias("valid_rows"),
    ).withColumn("valid_pct", F.col("valid_rows") * F.lit(100.0) / F.col("rows"))


def file_month_coherence(landing: DataFrame, tolerance_days: int = 1) -> DataFrame:
    """Per source file: pickups outside the file's month, and outside it by more
    than ``tolerance_days`` (the month comes from the file name)."""
    from farebox.sources.inventory import parse_file_identity
    ident = parse_file_identity("source_filename")
    first = F.make_date(ident["year"], ident["month"], F.lit(1))
    start = F.date_sub(first, tolerance_days)
    end = F.date_add(F.add_months(first, 1), tolerance_days - 1)
    d = F.to_date("pickup_datetime")
    outside = (F.year("pickup_datetime") != ident["year"]) | (F.month("pickup_datetime") != ident["month"])
    far = (d < start) | (d > end)
    return landing.groupBy("source_kind", "source_file_id", "source_filename").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("pickup_datetime").alias("rows_with_pickup"),
        F.count(F.when(outside, 1)).alias("outside_month"),
        F.count(F.when(far, 1)).alias("outside_tolerance"),
    )


def scenario_grid(daily: DataFrame, scenarios: list[dict]) -> DataFrame:
    """Net contribution of every daily cell under each cost scenario.

    The (few) scenarios are a literal array exploded per row — a generator,
    not a join — and the break-even observed amount per trip is reported too.
    """
    arr = F.array(*[F.struct(F.lit(s["name"]).alias("scenario"),
                             F.lit(float(s["commission_rate"])).alias("c"),
                             F.lit(float(s["variable_cost_per_mile"])).alias("v"),
                             F.lit(float(s["fixed_cost_per_trip"])).alias("f")) for s in scenarios])
    x = daily.select("zone_day_service_key", "date_key", "taxi_zone_key", "service_type_key", "trip_count",
                     "revenue_observation_count", "observed_trip_amount", "average_trip_distance",
                     F.explode(arr).alias("s"))
    amt, n = F.col("observed_trip_amount"), F.col("trip_count")
    dist = F.coalesce(F.col("average_trip_distance"), F.lit(0.0))
    net = amt - amt * F.col("s.c") - dist * n * F.col("s.v") - n * F.col("s.f")
    return x.select(
        "zone_day_service_key", "date_key", "taxi_zone_key", "service_type_key", F.col("s.scenario").alias("scenario"),
        "trip_count", "observed_trip_amount",
        F.when(F.col("revenue_observation_count") > 0, net).alias("estimated_net_contribution"),
        safe_div(dist * F.col("s.v") + F.col("s.f"), F.lit(1.0) - F.col("s.c")).alias("break_even_amount_per_trip"),
    )


# --- fixed values: meteorological seasons by month --------------------------------
SEASONS = (("winter", (12, 1, 2)), ("spring", (3, 4, 5)), ("summer", (6, 7, 8)), ("autumn", (9, 10, 11)))
# ---------------------------------------------------------------------------------


def enrich_calendar(hourly: DataFrame, date_dim: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Season (by month), holiday and holiday-eve flags on the hourly fact.

    ``holidays``: (holiday_date date, holiday_name string), user supplied.
    """
    d = date_dim.select("date_key", "full_date", "month")
    season = None
    for name, months in SEASONS:
        season = F.when(F.col("month").isin(*months), name) if season is None else season.when(
            F.col("month").isin(*months), name)
    d = d.withColumn("season", season)
    if holidays is not None:
        # two holidays on one date must not double its rows
        h = holidays.groupBy(F.col("holiday_date").alias("full_date")).agg(F.min("holiday_name").alias("holiday_name"))
        eve = holidays.select(F.date_sub("holiday_date", 1).alias("full_date"), F.lit(True).alias("is_holiday_eve"))
        d = d.join(h, "full_date", "left").join(eve.distinct(), "full_date", "left")
    else:
        d = d.withColumn("holiday_name", F.lit(None).cast("string")).withColumn("is_holiday_eve", F.lit(None).cast("boolean"))
    d = d.select("date_key", "season", F.col("holiday_name").isNotNull().alias("is_holiday"),
                 F.coalesce("is_holiday_eve", F.lit(False)).alias("is_holiday_eve"))
    return hourly.join(d, "date_key", "left")


def enrich_weather(hourly: DataFrame, weather: DataFrame) -> DataFrame:
    """Left equi-join of hourly weather (date_key, hour_key, …) onto the hourly fact.

    Weather is one row per hour of the span; Spark broadcasts it if it is small.
    """
    return hourly.join(weather, ["date_key", "hour_key"], "left")


def duplicate_profile(df: DataFrame, key: tuple[str, ...] = ("source_kind", "source_file_id", "source_row_number"),
                      by: tuple[str, ...] = ("service_type",)) -> DataFrame:
    """Per group: rows, distinct keys, keys seen more than once and the surplus rows.

    One partially aggregated ``groupBy`` over (group, key): a key repeated across a
    third of the input still ships one row per map task.
    """
    per_key = df.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*by).agg(
        F.sum("n").cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count(F.when(F.col("n") > 1, 1)).alias("duplicated_keys"),
        F.sum(F.col("n") - 1).cast("long").alias("duplicate_rows"),
    )
