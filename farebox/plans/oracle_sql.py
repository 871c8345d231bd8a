"""DuckDB oracle SQL for the registered queries.

Written independently of the Spark code: each query is plain SQL over the
driver's tables (``events``, ``nation``, ``region`` …).  CTEs are shared text
fragments assembled per query in dependency order.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def with_clause(*names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n][1]}\n)" for n in order)


def r6(inner: str, double_cols: list[str]) -> str:
    """Half-up round listed double columns to 6 decimals (same recipe as Spark side)."""
    if not double_cols:
        return inner
    rep = ", ".join(f"floor({c} * 1e6 + 0.501::DOUBLE) / 1e6 AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{inner}\n) AS q"


R6 = "floor(({x}) * 1e6 + 0.501::DOUBLE) / 1e6"

# --- fixture landing (FIXTURES.md §3) ----------------------------------------
cte("ev", (), """
SELECT event_id, ts, user_id, event_type, value,
       CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
       CASE event_type WHEN 'view' THEN 'fhvhv' WHEN 'purchase' THEN 'green'
                       WHEN 'signup' THEN 'fhv' ELSE 'yellow' END AS svc,
       CAST(event_id % 4 + 1 AS BIGINT) AS file_id
FROM events""")

cte("landing", ("ev",), """
SELECT 'demo' AS source_kind,
       file_id AS source_file_id,
       svc || '_tripdata_2024-01_' || CAST(file_id AS VARCHAR) AS source_filename,
       CAST(event_id AS BIGINT) AS source_row_number,
       svc AS service_type,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS pickup_datetime,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE ts + to_minutes(k - 2) END AS dropoff_datetime,
       CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(user_id % 12 AS INTEGER) * 22 END AS pickup_location_id,
       CASE WHEN event_id % 79 = 0 THEN NULL ELSE CAST((user_id * 7 + k) % 268 AS INTEGER) END AS dropoff_location_id,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 101 = 0 THEN -value ELSE value / 10 END AS trip_distance,
       CASE WHEN event_type = 'signup' THEN NULL WHEN event_id % 103 = 0 THEN -value ELSE value END AS total_amount,
       CAST(NULL AS VARCHAR) AS dispatching_base_num,
       CAST(NULL AS VARCHAR) AS hvfhs_license_num
FROM ev""")

cte("zone_seed", (), """
SELECT CAST(i.range AS INTEGER) AS location_id,
       r.r_name AS borough,
       n.n_name || '-' || CAST(i.range AS VARCHAR) AS zone_name,
       CASE i.range % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
FROM range(1, 266) AS i
JOIN nation AS n ON n.n_nationkey = i.range % 25
JOIN region AS r ON r.r_regionkey = n.n_regionkey""")

# --- staging / silver ----------------------------------------------------------
# validity rules in order; a row's reason is the first rule that it breaks
RULES = [
    ("missing_pickup_datetime", "pickup_datetime IS NULL"),
    ("missing_dropoff_datetime", "dropoff_datetime IS NULL"),
    ("dropoff_before_pickup", "epoch_us(dropoff_datetime) - epoch_us(pickup_datetime) < 0"),
    ("missing_pickup_location", "pickup_location_id IS NULL"),
    ("missing_dropoff_location", "dropoff_location_id IS NULL"),
    ("invalid_pickup_location", "pickup_location_id < 1 OR pickup_location_id > 265"),
    ("invalid_dropoff_location", "dropoff_location_id < 1 OR dropoff_location_id > 265"),
    ("negative_trip_distance", "trip_distance < 0"),
    ("negative_total_amount", "total_amount < 0"),
]
_BROKEN = ", ".join(f"if({broken}, {i}, NULL)" for i, (_, broken) in enumerate(RULES, 1))
_NAMES = ", ".join(f"'{name}'" for name, _ in RULES)

cte("stg", ("landing",), f"""
SELECT md5(source_kind || '|' || source_file_id || '|' || source_row_number) AS trip_id,
       *,
       (epoch_us(dropoff_datetime) - epoch_us(pickup_datetime)) / 60000000.0::DOUBLE AS duration_minutes,
       ([{_NAMES}])[list_min([{_BROKEN}])] AS invalid_reason
FROM landing""")

cte("silver", ("stg",), """
SELECT * EXCLUDE (invalid_reason) FROM stg WHERE invalid_reason IS NULL""")

cte("quarantine", ("stg",), """
SELECT * FROM stg WHERE invalid_reason IS NOT NULL""")

SPEED = ("CASE WHEN duration_minutes > 0 AND trip_distance IS NOT NULL "
         "THEN trip_distance / (duration_minutes / 60.0::DOUBLE) END")

_DAY = "CAST(year({0}) * 10000 + month({0}) * 100 + day({0}) AS INTEGER)"

cte("fact_trip", ("silver",), f"""
SELECT * EXCLUDE (source_filename, pickup_location_id, dropoff_location_id, service_type, total_amount,
                  dispatching_base_num, hvfhs_license_num),
       {_DAY.format('pickup_datetime')} AS pickup_date_key,
       CAST(hour(pickup_datetime) AS SMALLINT) AS pickup_hour_key,
       pickup_location_id AS pickup_taxi_zone_key, dropoff_location_id AS dropoff_taxi_zone_key,
       service_type AS service_type_key, total_amount AS observed_trip_amount,
       total_amount IS NOT NULL AS has_observed_amount, {SPEED} AS average_speed_mph
FROM silver""")

# both grains at once, from trip rows: a cell is (day, hour, zone, service), or the same without the hour
cte("cells", ("silver",), f"""
SELECT d, h, pickup_location_id AS taxi_zone_key, service_type AS service_type_key, grouping(h) = 1 AS whole_day,
       CAST(count(*) AS BIGINT) AS trip_count,
       CAST(count(total_amount) AS BIGINT) AS revenue_observation_count,
       sum(total_amount) AS observed_trip_amount,
       sum(duration_minutes) / nullif(count(duration_minutes), 0) AS average_duration_minutes,
       sum(trip_distance) / nullif(count(trip_distance), 0) AS average_trip_distance,
       sum(speed) / nullif(count(speed), 0) AS average_speed_mph,
       sum(duration_minutes / 60.0::DOUBLE) AS occupied_hours
FROM (SELECT *, CAST(pickup_datetime AS DATE) AS d, CAST(hour(pickup_datetime) AS SMALLINT) AS h, {SPEED} AS speed FROM silver) AS t
GROUP BY GROUPING SETS ((d, h, pickup_location_id, service_type), (d, pickup_location_id, service_type))""")

cte("hourly", ("cells",), f"""
SELECT md5(d::VARCHAR || '|' || h || '|' || taxi_zone_key || '|' || service_type_key) AS zone_hour_service_key,
       {_DAY.format('d')} AS date_key, h AS hour_key, * EXCLUDE (d, h, whole_day)
FROM cells WHERE NOT whole_day""")

cte("daily", ("cells",), f"""
SELECT md5(d::VARCHAR || '|' || taxi_zone_key || '|' || service_type_key) AS zone_day_service_key,
       {_DAY.format('d')} AS date_key, * EXCLUDE (d, h, whole_day)
FROM cells WHERE whole_day""")

cte("dim_zone", ("zone_seed",), """
SELECT location_id AS taxi_zone_key, borough, zone_name, service_zone FROM zone_seed""")

cte("dim_service", (), """
SELECT * FROM (VALUES ('yellow', 'Yellow Taxi', true, true),
                      ('green', 'Green Taxi', true, true),
                      ('fhv', 'For-Hire Vehicle', false, false),
                      ('fhvhv', 'High Volume For-Hire Vehicle', true, true))
       AS s(service_type_key, service_type_name, supports_distance, supports_observed_amount)""")

cte("dim_time", (), """
SELECT CAST(h AS SMALLINT) AS hour_key,
       lpad(CAST(h AS VARCHAR), 2, '0') || ':00:00' AS hour_start,
       lpad(CAST(h AS VARCHAR), 2, '0') || ':00' AS hour_label,
       CASE WHEN h BETWEEN 0 AND 5 THEN 'overnight'
            WHEN h BETWEEN 6 AND 9 THEN 'morning_peak'
            WHEN h BETWEEN 10 AND 15 THEN 'midday'
            WHEN h BETWEEN 16 AND 19 THEN 'evening_peak'
            ELSE 'night' END AS day_period
FROM (SELECT CAST(range AS INTEGER) AS h FROM range(0, 24)) AS t""")

cte("dim_date", ("silver",), """
SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key,
       full_date,
       CAST(extract(year FROM full_date) AS SMALLINT) AS year,
       CAST(extract(quarter FROM full_date) AS SMALLINT) AS quarter,
       CAST(extract(month FROM full_date) AS SMALLINT) AS month,
       CAST(extract(day FROM full_date) AS SMALLINT) AS day_of_month,
       CAST(isodow(full_date) AS SMALLINT) AS iso_day_of_week,
       dayname(full_date) AS day_name,
       CAST(weekofyear(full_date) AS SMALLINT) AS iso_week,
       isodow(full_date) IN (6, 7) AS is_weekend
FROM (
  SELECT CAST(unnest(generate_series(CAST(min(CAST(pickup_datetime AS DATE)) AS TIMESTAMP),
                                     CAST(max(CAST(pickup_datetime AS DATE)) AS TIMESTAMP),
                                     INTERVAL 1 DAY)) AS DATE) AS full_date
  FROM silver
  HAVING min(pickup_datetime) IS NOT NULL) AS d""")

cte("zone_cells", ("hourly", "dim_zone"), """
SELECT hourly.*, borough, zone_name FROM hourly JOIN dim_zone USING (taxi_zone_key)""")

cte("driver_opportunity", ("zone_cells",), """
SELECT c.* EXCLUDE (revenue_observation_count, average_duration_minutes, average_trip_distance, average_speed_mph),
       if(occupied_hours = 0, NULL, observed_trip_amount / occupied_hours) AS observed_amount_per_occupied_hour,
       100.0::DOUBLE * trip_count / busiest AS relative_demand_score
FROM zone_cells AS c
JOIN (SELECT date_key, hour_key, service_type_key, max(trip_count) AS busiest FROM zone_cells GROUP BY ALL) AS b
     USING (date_key, hour_key, service_type_key)""")

cte("congestion", ("zone_cells",), """
SELECT * EXCLUDE (revenue_observation_count, observed_trip_amount, occupied_hours),
       if(average_trip_distance > 0, average_duration_minutes / average_trip_distance, NULL) AS minutes_per_mile_proxy
FROM zone_cells""")

cte("profitability", ("daily", "dim_zone"), """
SELECT * EXCLUDE (average_duration_minutes, average_speed_mph, occupied_hours, service_zone),
       0.20::DECIMAL(10,4) AS assumed_commission_rate, 0.35::DECIMAL(10,4) AS assumed_variable_cost_per_mile,
       1.50::DECIMAL(10,4) AS assumed_fixed_cost_per_trip,
       if(revenue_observation_count = 0, NULL, 0.80::DOUBLE * observed_trip_amount
          - trip_count * (1.50::DOUBLE + 0.35::DOUBLE * coalesce(average_trip_distance, 0))) AS estimated_net_contribution_scenario
FROM daily NATURAL JOIN dim_zone""")

# from trip rows: totals need no daily fact
cte("overview", ("silver", "daily", "dim_service"), f"""
SELECT {_DAY.format('pickup_datetime')} AS date_key, service_type_key, service_type_name,
       count(*) AS trip_count, CAST(count(DISTINCT pickup_location_id) AS INTEGER) AS active_pickup_zones,
       count(total_amount) AS revenue_observation_count, sum(total_amount) AS observed_trip_amount,
       sum(duration_minutes) / 60.0::DOUBLE AS occupied_hours,
       avg(duration_minutes) AS weighted_average_duration_minutes, any_value(w.mean) AS weighted_average_trip_distance
FROM silver JOIN dim_service ON service_type = service_type_key
LEFT JOIN (SELECT date_key AS k, service_type_key AS s, sum(average_trip_distance * trip_count) / sum(trip_count) AS mean
           FROM daily WHERE average_trip_distance IS NOT NULL GROUP BY ALL) AS w
     ON w.s = service_type AND w.k = {_DAY.format('pickup_datetime')}
GROUP BY date_key, service_type_key, service_type_name""")

cte("service_comparison", ("silver", "dim_service"), f"""
SELECT service_type_key, service_type_name, CAST(nullif(count(trip_id), 0) AS BIGINT) AS trip_count,
       CAST(count(DISTINCT {_DAY.format('pickup_datetime')}) AS INTEGER) AS active_days,
       CAST(count(DISTINCT pickup_location_id) AS INTEGER) AS active_pickup_zones,
       if(count(trip_id) = 0, NULL, count(total_amount)) AS revenue_observation_count,
       sum(total_amount) AS observed_trip_amount, sum(duration_minutes) / 60.0::DOUBLE AS occupied_hours,
       sum(total_amount) / nullif(count(total_amount), 0) AS observed_amount_per_priced_trip
FROM dim_service LEFT JOIN silver ON service_type = service_type_key
GROUP BY ALL""")


def select_from(cte_name: str, columns: str = "*", double_cols: list[str] | None = None,
                tail: str = "") -> str:
    inner = f"{with_clause(cte_name)}\nSELECT {columns} FROM {cte_name} {tail}"
    return r6(inner, double_cols or [])
