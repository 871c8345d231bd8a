"""Oracle SQL per registered query key (DuckDB dialect)."""

from __future__ import annotations

from farebox.plans.oracle_sql import r6, select_from, with_clause

HOURLY_DOUBLES = ["observed_trip_amount", "average_duration_minutes", "average_trip_distance",
                  "average_speed_mph", "occupied_hours"]

ORACLES: dict[str, str] = {
    "stg_trip_records": select_from("stg"),
    "silver_trips": select_from("silver"),
    "trip_quarantine": select_from("quarantine"),
    "fact_trip": select_from("fact_trip"),
    "dim_date": select_from("dim_date"),
    "dim_taxi_zone": select_from("dim_zone"),
    "fact_zone_hourly_demand": select_from("hourly", double_cols=HOURLY_DOUBLES),
    "fact_zone_daily_performance": select_from("daily", double_cols=HOURLY_DOUBLES),
    "quarantine_by_reason": with_clause("quarantine") + """
SELECT invalid_reason, CAST(count(*) AS BIGINT) AS trip_count FROM quarantine GROUP BY 1""",
    "run_row_counters": with_clause("stg") + """
SELECT CAST(count(*) AS BIGINT) AS rows_read,
       CAST(count(*) FILTER (WHERE invalid_reason IS NULL) AS BIGINT) AS rows_valid,
       CAST(count(*) FILTER (WHERE invalid_reason IS NOT NULL) AS BIGINT) AS rows_rejected
FROM stg""",
    "mart_driver_opportunity": select_from(
        "driver_opportunity", double_cols=["observed_trip_amount", "occupied_hours",
                                           "observed_amount_per_occupied_hour",
                                           "relative_demand_score"]),
    "mart_congestion_proxy": select_from(
        "congestion", double_cols=["average_duration_minutes", "average_trip_distance",
                                   "average_speed_mph", "minutes_per_mile_proxy"]),
    "mart_profitability_scenario": select_from(
        "profitability", double_cols=["observed_trip_amount", "average_trip_distance",
                                      "estimated_net_contribution_scenario"]),
    "mart_mobility_overview": select_from(
        "overview", double_cols=["observed_trip_amount", "occupied_hours",
                                 "weighted_average_duration_minutes",
                                 "weighted_average_trip_distance"]),
    "mart_service_comparison": select_from(
        "service_comparison", double_cols=["observed_trip_amount", "occupied_hours",
                                           "observed_amount_per_priced_trip"]),
}

# --- checks -------------------------------------------------------------------------------
from farebox.plans.oracle_sql import cte  # noqa: E402

#: Each model's relation, not_null columns, unique columns.
_MODEL_TESTS = [
    ("landing", "landing", "source_file_id source_row_number service_type", ""),
    ("stg_trip_records", "stg", "trip_id service_type source_file_id", "trip_id"),
    ("trips", "silver", "trip_id pickup_datetime dropoff_datetime pickup_location_id dropoff_location_id", "trip_id"),
    ("trip_quarantine", "quarantine", "trip_id invalid_reason", "trip_id"),
    ("taxi_zone_lookup", "zone_seed", "location_id borough zone_name", "location_id"),
    ("dim_service_type", "dim_service", "service_type_key", "service_type_key"),
    ("dim_taxi_zone", "dim_zone", "taxi_zone_key borough zone_name", "taxi_zone_key"),
    ("dim_date", "dim_date", "date_key full_date", "date_key full_date"),
    ("dim_time", "dim_time", "hour_key day_period", "hour_key"),
    ("fact_trip", "fact_trip", "trip_id pickup_date_key pickup_hour_key pickup_taxi_zone_key dropoff_taxi_zone_key service_type_key", "trip_id"),
    ("fact_zone_hourly_demand", "hourly", "zone_hour_service_key date_key hour_key taxi_zone_key service_type_key trip_count", "zone_hour_service_key"),
    ("fact_zone_daily_performance", "daily", "zone_day_service_key date_key taxi_zone_key service_type_key trip_count", "zone_day_service_key"),
    ("mart_mobility_overview", "overview", "date_key service_type_key", ""),
    ("mart_service_comparison", "service_comparison", "service_type_key", "service_type_key"),
    ("mart_driver_opportunity", "driver_opportunity", "zone_hour_service_key", "zone_hour_service_key"),
    ("mart_congestion_proxy", "congestion", "zone_hour_service_key", "zone_hour_service_key"),
    ("mart_profitability_scenario", "profitability", "zone_day_service_key", "zone_day_service_key"),
]
_SERVICE_VALUES = "'yellow', 'green', 'fhv', 'fhvhv'"
_ACCEPTED = [("landing", "service_type", _SERVICE_VALUES), ("stg_trip_records", "service_type", _SERVICE_VALUES),
             ("dim_service_type", "service_type_key", _SERVICE_VALUES),
             ("dim_time", "day_period", "'overnight', 'morning_peak', 'midday', 'evening_peak', 'night'")]
#: Child, column, parent, parent's column.
_REFERENCES = [
    ("fact_trip", "pickup_date_key", "dim_date", "date_key"),
    ("fact_trip", "pickup_hour_key", "dim_time", "hour_key"),
    ("fact_trip", "pickup_taxi_zone_key", "dim_taxi_zone", "taxi_zone_key"),
    ("fact_trip", "dropoff_taxi_zone_key", "dim_taxi_zone", "taxi_zone_key"),
    ("fact_trip", "service_type_key", "dim_service_type", "service_type_key"),
    ("fact_zone_hourly_demand", "date_key", "dim_date", "date_key"),
    ("fact_zone_hourly_demand", "hour_key", "dim_time", "hour_key"),
    ("fact_zone_hourly_demand", "taxi_zone_key", "dim_taxi_zone", "taxi_zone_key"),
    ("fact_zone_hourly_demand", "service_type_key", "dim_service_type", "service_type_key"),
    ("fact_zone_daily_performance", "date_key", "dim_date", "date_key"),
    ("fact_zone_daily_performance", "taxi_zone_key", "dim_taxi_zone", "taxi_zone_key"),
    ("fact_zone_daily_performance", "service_type_key", "dim_service_type", "service_type_key"),
]


def suite_sql(damaged: tuple[str, ...] = ()) -> str:
    """The 83 checks; the relations named in ``damaged`` are read as <name>_damaged."""
    relations = {model: rel for model, rel, _, _ in _MODEL_TESTS}
    name = lambda rel: f"{rel}_damaged" if rel in damaged else rel
    of = {model: name(rel) for model, rel in relations.items()}
    rows = []   # check, model, test, failing rows

    for model, _, not_null, unique in _MODEL_TESTS:
        rows += [(f"not_null__{model}__{c}", model, "not_null", f"SELECT 1 FROM {of[model]} WHERE {c} IS NULL") for c in not_null.split()]
        rows += [(f"unique__{model}__{c}", model, "unique",
                  f"SELECT 1 FROM {of[model]} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1") for c in unique.split()]
    rows += [(f"accepted_values__{model}__{c}", model, "accepted_values",
              f"SELECT 1 FROM {of[model]} WHERE {c} NOT IN ({values}) GROUP BY {c}") for model, c, values in _ACCEPTED]
    rows += [(f"relationships__{child}__{c}__{parent}", child, "relationships",
              f"SELECT 1 FROM {of[child]} x WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {of[parent]} y WHERE y.{field} = x.{c})")
             for child, c, parent, field in _REFERENCES]
    rows += [
        ("fact_trip_measures_are_non_negative", "fact_trip", "singular",
         f"SELECT 1 FROM {of['fact_trip']} WHERE duration_minutes < 0 OR trip_distance < 0 OR average_speed_mph < 0"),
        ("gold_counts_are_consistent", "fact_zone_hourly_demand", "singular",
         f"SELECT 1 FROM {of['fact_zone_hourly_demand']} WHERE NOT (trip_count > 0 AND revenue_observation_count BETWEEN 0 AND trip_count)"),
        ("gold_trip_totals_reconcile", "trips,fact_zone_daily_performance", "singular",
         f"SELECT 1 WHERE (SELECT count(*) FROM {of['trips']}) <> (SELECT sum(trip_count) FROM {of['fact_zone_daily_performance']})"),
        ("trips_have_non_negative_duration", "trips", "singular", f"SELECT 1 FROM {of['trips']} WHERE duration_minutes < 0")]
    body = "\nUNION ALL\n".join(f"SELECT '{check}' AS check_name, '{model}' AS model, '{test}' AS test, CAST(count(*) AS BIGINT) AS failures "
                                 f"FROM ({sql}) AS f" for check, model, test, sql in rows)
    return (with_clause(*of.values()) + "\nSELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END "
            f"AS status FROM (\n{body}\n) AS r")


cte("landing_damaged", ("landing",), """
SELECT * REPLACE (CASE WHEN source_row_number % 97 = 0 THEN 'taxi' WHEN source_row_number % 89 = 0 THEN NULL ELSE service_type END AS service_type)
FROM landing""")
cte("silver_damaged", ("silver",), """
SELECT * REPLACE (CASE WHEN source_row_number % 113 = 0 THEN -5.0 ELSE duration_minutes END AS duration_minutes) FROM silver""")
cte("fact_trip_damaged", ("fact_trip",), """
SELECT * REPLACE (CASE WHEN source_row_number % 101 = 0 THEN 999 ELSE pickup_taxi_zone_key END AS pickup_taxi_zone_key,
                  CASE WHEN source_row_number % 103 = 0 THEN NULL ELSE service_type_key END AS service_type_key,
                  CASE WHEN source_row_number % 107 = 0 THEN -1.0 ELSE duration_minutes END AS duration_minutes) FROM fact_trip
UNION ALL SELECT * FROM fact_trip WHERE source_row_number % 109 = 0""")
cte("hourly_damaged", ("hourly",), """
SELECT * REPLACE (CASE WHEN hour_key = 3 THEN 0 ELSE trip_count END AS trip_count) FROM hourly""")
cte("daily_damaged", ("daily",), """
SELECT * REPLACE (CASE WHEN taxi_zone_key = 22 THEN trip_count + 1 ELSE trip_count END AS trip_count) FROM daily""")
cte("dim_date_damaged", ("dim_date",), "SELECT * FROM dim_date WHERE date_key > (SELECT min(date_key) FROM dim_date)")
cte("dim_time_damaged", ("dim_time",), """
SELECT * REPLACE (CASE WHEN hour_key IN (12, 13) THEN 'noon' ELSE day_period END AS day_period) FROM dim_time""")

ORACLES["data_quality_suite_damaged"] = suite_sql(("landing", "silver", "fact_trip", "hourly", "daily", "dim_date", "dim_time"))
ORACLES["check_gold_counts_damaged"] = with_clause("hourly_damaged") + """
SELECT zone_hour_service_key, trip_count, revenue_observation_count FROM hourly_damaged
WHERE trip_count <= 0 OR revenue_observation_count < 0 OR revenue_observation_count > trip_count"""

ORACLES.update({
    "data_quality_suite": suite_sql(),
    "check_not_null": with_clause("stg") + "\nSELECT * FROM stg WHERE dropoff_datetime IS NULL",
    "check_unique": with_clause("landing") + """
SELECT source_filename AS unique_field, count(*) AS n_records FROM landing
WHERE source_filename IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "check_accepted_values": with_clause("stg") + f"""
SELECT * FROM (SELECT invalid_reason AS value_field, count(*) AS n_records FROM stg GROUP BY 1) v
WHERE value_field = 'invalid_pickup_location'""",
    "check_relationships": with_clause("stg", "dim_zone") + """
SELECT s.dropoff_location_id AS from_field FROM stg s
WHERE s.dropoff_location_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM dim_zone z WHERE z.taxi_zone_key = s.dropoff_location_id)""",
    "check_non_negative_measures": with_clause("stg") + """
SELECT * FROM (
SELECT trip_id,
       CAST(strftime(pickup_datetime, '%Y%m%d') AS INTEGER) AS pickup_date_key,
       CAST(extract(hour FROM pickup_datetime) AS SMALLINT) AS pickup_hour_key,
       pickup_location_id AS pickup_taxi_zone_key, dropoff_location_id AS dropoff_taxi_zone_key,
       service_type AS service_type_key, pickup_datetime, dropoff_datetime, duration_minutes, trip_distance,
       total_amount AS observed_trip_amount, total_amount IS NOT NULL AS has_observed_amount,
       CASE WHEN duration_minutes > 0 AND trip_distance IS NOT NULL
            THEN trip_distance / (duration_minutes / 60.0::DOUBLE) END AS average_speed_mph,
       source_kind, source_file_id, source_row_number
FROM stg) f
WHERE duration_minutes < 0 OR trip_distance < 0 OR average_speed_mph < 0""",
    "check_gold_counts": with_clause("hourly") + """
SELECT zone_hour_service_key, date_key, hour_key, taxi_zone_key, service_type_key, trip_count,
       revenue_observation_count
FROM hourly WHERE trip_count <= 0 OR revenue_observation_count < 0 OR revenue_observation_count > trip_count""",
    "check_totals_reconcile": with_clause("stg", "daily") + """
SELECT s.c AS silver_count, g.c AS gold_count
FROM (SELECT CAST(count(*) AS BIGINT) AS c FROM stg) s,
     (SELECT CAST(sum(trip_count) AS BIGINT) AS c FROM daily) g
WHERE s.c IS DISTINCT FROM g.c""",
    "check_non_negative_duration": with_clause("stg") + "\nSELECT trip_id FROM stg WHERE duration_minutes < 0",
})

# --- forecasting -----------------------------------------------------------------------------
cte("panel", ("hourly", "dim_date", "dim_time"), """
SELECT CAST(d.full_date AS TIMESTAMP) + to_hours(CAST(h.hour_key AS INTEGER)) AS target_timestamp,
       h.service_type_key AS service_type, h.taxi_zone_key,
       CAST(h.trip_count AS DOUBLE) AS demand
FROM hourly h JOIN dim_date d ON h.date_key = d.date_key JOIN dim_time t ON h.hour_key = t.hour_key""")

cte("dense", ("panel",), """
SELECT g.service_type, g.taxi_zone_key, g.target_timestamp, coalesce(p.demand, 0.0::DOUBLE) AS demand
FROM (
  SELECT service_type, taxi_zone_key,
         unnest(generate_series(min(target_timestamp), max(target_timestamp), INTERVAL 1 HOUR)) AS target_timestamp
  FROM panel GROUP BY 1, 2) g
LEFT JOIN (SELECT service_type, taxi_zone_key, target_timestamp, max(demand) AS demand
           FROM panel GROUP BY 1, 2, 3) p
  USING (service_type, taxi_zone_key, target_timestamp)""")

FEATURE_DOUBLES = ["lag_origin", "lag_origin_1", "lag_origin_24", "rolling_mean_24", "hour_sin",
                   "hour_cos", "weekday_sin", "weekday_cos", "service_code", "zone_code", "target",
                   "baseline"]


def _features_cte(h: int) -> None:
    w = "PARTITION BY service_type, taxi_zone_key ORDER BY target_timestamp"
    cte(f"features_{h}", ("dense",), f"""
SELECT service_type, taxi_zone_key, target_timestamp, {h} AS horizon_hours,
       lag_origin, lag_origin_1, lag_origin_24, rolling_mean_24,
       sin(2 * pi() * hr / 24.0) AS hour_sin, cos(2 * pi() * hr / 24.0) AS hour_cos,
       sin(2 * pi() * wd / 7.0) AS weekday_sin, cos(2 * pi() * wd / 7.0) AS weekday_cos,
       CASE service_type WHEN 'yellow' THEN 0.0 WHEN 'green' THEN 1.0 WHEN 'fhv' THEN 2.0
                         WHEN 'fhvhv' THEN 3.0 END AS service_code,
       CAST(taxi_zone_key AS DOUBLE) AS zone_code,
       demand AS target, baseline
FROM (
  SELECT *, CAST(extract(hour FROM target_timestamp) AS DOUBLE) AS hr,
         CAST(isodow(target_timestamp) - 1 AS DOUBLE) AS wd,
         row_number() OVER ({w}) - 1 AS series_index,
         lag(demand, {h}) OVER ({w}) AS lag_origin,
         lag(demand, {h + 1}) OVER ({w}) AS lag_origin_1,
         lag(demand, {h + 24}) OVER ({w}) AS lag_origin_24,
         avg(demand) OVER ({w} ROWS BETWEEN {h + 23} PRECEDING AND {h} PRECEDING) AS rolling_mean_24,
         lag(demand, 24) OVER ({w}) AS baseline
  FROM dense) x
WHERE series_index >= 48""")
    cte(f"split_{h}", (f"features_{h}",), f"""
SELECT f.*, CASE WHEN f.target_timestamp < c.cutoff THEN 'train' ELSE 'test' END AS split, c.cutoff
FROM features_{h} f, (
  SELECT ts AS cutoff FROM (
    SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS pos, count(*) OVER () AS n
    FROM (SELECT DISTINCT target_timestamp AS ts FROM features_{h}) d) r
  WHERE pos = CAST(floor(n * (1.0::DOUBLE - 0.2::DOUBLE)) AS BIGINT)) c""")
    cte(f"naive_{h}", (f"split_{h}",), f"""
SELECT 'seasonal_naive' AS model_name, CAST({h} AS SMALLINT) AS horizon_hours, target_timestamp,
       service_type, taxi_zone_key, target AS actual_demand, CAST(baseline AS DOUBLE) AS predicted_demand,
       'test' AS split
FROM split_{h} WHERE split = 'test'""")


_features_cte(1)
_features_cte(24)

cte("naive", ("naive_1", "naive_24"), "SELECT * FROM naive_1 UNION ALL SELECT * FROM naive_24")

cte("naive_metrics", ("naive",), """
SELECT model_name, horizon_hours, 'test' AS split,
       avg(abs(e)) AS mae, sqrt(avg(e * e)) AS rmse,
       sum(abs(e)) / nullif(sum(abs(actual_demand)), 0) AS wape,
       CASE WHEN count(*) <= 1 THEN NULL
            WHEN sum((actual_demand - m) * (actual_demand - m)) = 0
                 THEN CASE WHEN sum(e * e) = 0 THEN 1.0 ELSE 0.0 END
            ELSE 1.0 - sum(e * e) / sum((actual_demand - m) * (actual_demand - m)) END AS r2,
       CAST(count(*) AS INTEGER) AS sample_count
FROM (SELECT *, actual_demand - predicted_demand AS e,
             avg(actual_demand) OVER (PARTITION BY model_name, horizon_hours) AS m FROM naive) x
GROUP BY 1, 2""")

ORACLES.update({
    "hourly_panel": select_from("panel"),
    "densify_hourly": select_from("dense"),
    "forecast_features_1h": select_from("features_1", double_cols=FEATURE_DOUBLES),
    "forecast_features_24h": select_from("features_24", double_cols=FEATURE_DOUBLES),
    "temporal_split": with_clause("split_1", "split_24") + """
SELECT service_type, taxi_zone_key, target_timestamp, horizon_hours, split, cutoff FROM split_1
UNION ALL
SELECT service_type, taxi_zone_key, target_timestamp, horizon_hours, split, cutoff FROM split_24""",
    "seasonal_naive_predictions": select_from("naive"),
    "forecast_metrics_naive": r6(with_clause("naive_metrics") + """
SELECT *, row_number() OVER (PARTITION BY horizon_hours ORDER BY mae ASC NULLS LAST) = 1 AS is_selected
FROM naive_metrics""", ["mae", "rmse", "wape", "r2"]),
    "forecast_error_by_hour": r6(with_clause("naive") + """
SELECT model_name, horizon_hours, CAST(extract(hour FROM target_timestamp) AS INTEGER) AS hour,
       count(*) AS sample_count, avg(abs(actual_demand - predicted_demand)) AS mae,
       sum(abs(actual_demand - predicted_demand)) / nullif(sum(abs(actual_demand)), 0) AS wape,
       avg(CASE WHEN actual_demand <> 0 THEN abs(actual_demand - predicted_demand) / abs(actual_demand) END) AS mape
FROM naive GROUP BY 1, 2, 3""", ["mae", "wape", "mape"]),
})

# --- ingest ------------------------------------------------------------------------------------
from farebox.schemas import DEFAULT_BASE_URL  # noqa: E402

cte("inv_req", ("landing",), """
SELECT min(pickup_datetime) AS start_date,
       max(pickup_datetime) + INTERVAL 2 MONTH AS end_date,
       string_agg(DISTINCT service_type, ',' ORDER BY service_type) AS services
FROM landing""")

cte("inventory", ("inv_req",), f"""
SELECT 'tlc' AS source_kind, svc AS service_type,
       CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
       svc || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' AS filename,
       '{DEFAULT_BASE_URL}/' || svc || '_tripdata_' || strftime(m, '%Y-%m') || '.parquet' AS source_url
FROM (SELECT unnest(generate_series(date_trunc('month', start_date), date_trunc('month', end_date),
                                    INTERVAL 1 MONTH)) AS m, services
      FROM inv_req WHERE date_trunc('month', start_date) <= date_trunc('month', end_date)) ms,
     (SELECT unnest(string_split(services, ',')) AS raw FROM inv_req) sv(raw),
     (SELECT regexp_replace(sv.raw, '\\s', '', 'g') AS svc) t""")


def _manifest_sql(where: str, status: str, run: str) -> str:
    fname = "service_type || '_tripdata_' || lpad(CAST(y AS VARCHAR), 4, '0') || '-' || lpad(CAST(m AS VARCHAR), 2, '0') || '.parquet'"
    return f"""
SELECT 'tlc' AS source_kind, service_type, CAST(y AS SMALLINT) AS year, CAST(m AS SMALLINT) AS month,
       {fname} AS filename, '{DEFAULT_BASE_URL}/' || {fname} AS source_url,
       CAST(n * 100 AS BIGINT) AS size_bytes,
       sha256({fname} || '|' || CAST(n AS VARCHAR)) AS sha256,
       CAST(n AS BIGINT) AS row_count, '{status}' AS status, '{run}' AS first_run_id, '{run}' AS last_run_id
FROM (SELECT service_type, year(pickup_datetime) AS y, month(pickup_datetime) AS m, count(*) AS n
      FROM landing WHERE pickup_datetime IS NOT NULL {where} GROUP BY 1, 2, 3) g"""


cte("manifest_run1_raw", ("landing",),
    _manifest_sql("AND pickup_datetime < TIMESTAMP '2024-01-16 00:00:00'", "DOWNLOADED", "run-1"))
cte("manifest_run1", ("manifest_run1_raw",), """
SELECT CAST(row_number() OVER (ORDER BY source_kind, service_type, year, month, filename) AS BIGINT) AS file_id, *
FROM manifest_run1_raw""")
cte("manifest_processed", ("landing",), _manifest_sql("", "PROCESSED", "run-2"))
cte("manifest_run2", ("manifest_processed", "inventory"), """
SELECT i.source_kind, i.service_type, CAST(i.year AS SMALLINT) AS year, CAST(i.month AS SMALLINT) AS month,
       i.filename, i.source_url, CAST(NULL AS BIGINT) AS size_bytes, CAST(NULL AS VARCHAR) AS sha256,
       CAST(NULL AS BIGINT) AS row_count, 'DISCOVERED' AS status, 'run-2' AS first_run_id, 'run-2' AS last_run_id
FROM inventory i
WHERE NOT EXISTS (SELECT 1 FROM manifest_processed p WHERE p.source_kind = i.source_kind
                  AND p.service_type = i.service_type AND p.year = i.year AND p.month = i.month
                  AND p.filename = i.filename)
UNION ALL SELECT * FROM manifest_processed""")
cte("manifest_merged", ("manifest_run1", "manifest_run2"), """
SELECT CAST(CASE WHEN e.file_id IS NULL
                 THEN (SELECT coalesce(max(file_id), 0) FROM manifest_run1)
                      + row_number() OVER (PARTITION BY e.file_id IS NULL
                                           ORDER BY source_kind, service_type, year, month, filename)
                 ELSE e.file_id END AS BIGINT) AS file_id,
       source_kind, service_type, year, month, filename,
       CASE WHEN e.status IS NULL THEN n.source_url ELSE e.source_url END AS source_url,
       CASE WHEN n.status IS NOT NULL THEN n.size_bytes ELSE e.size_bytes END AS size_bytes,
       CASE WHEN n.status IS NOT NULL THEN n.sha256 ELSE e.sha256 END AS sha256,
       CASE WHEN e.status IS NULL THEN n.row_count ELSE e.row_count END AS row_count,
       CASE WHEN n.status IS NOT NULL THEN n.status ELSE e.status END AS status,
       coalesce(e.first_run_id, n.first_run_id) AS first_run_id,
       CASE WHEN n.status IS NOT NULL THEN n.last_run_id ELSE e.last_run_id END AS last_run_id
FROM manifest_run1 e FULL OUTER JOIN manifest_run2 n
  USING (source_kind, service_type, year, month, filename)""")

ORACLES.update({
    "trip_file_inventory": select_from("inventory"),
    "pending_files": with_clause("inventory", "manifest_merged") + """
SELECT source_kind, service_type, CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month,
       filename, source_url
FROM inventory i
WHERE NOT EXISTS (SELECT 1 FROM manifest_merged m WHERE m.status IN ('VALIDATED', 'PROCESSED')
                  AND m.source_kind = i.source_kind AND m.service_type = i.service_type
                  AND m.year = i.year AND m.month = i.month AND m.filename = i.filename)""",
    "upsert_manifest": select_from("manifest_merged"),
    "bronze_coverage": with_clause("manifest_merged") + """
SELECT service_type, min(make_date(year, month, 1)) AS first_month, max(make_date(year, month, 1)) AS last_month,
       CAST(count(*) AS BIGINT) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes
FROM manifest_merged WHERE source_kind = 'tlc' AND status IN ('VALIDATED', 'PROCESSED')
GROUP BY 1 ORDER BY 1""",
    "parse_file_identity": with_clause("landing") + """
SELECT source_filename,
       CASE WHEN s = '' THEN NULL WHEN s = 'hvfhv' THEN 'fhvhv' ELSE s END AS service_type,
       CASE WHEN s = '' THEN NULL ELSE CAST(y AS INTEGER) END AS year,
       CASE WHEN s = '' THEN NULL ELSE CAST(mo AS INTEGER) END AS month,
       CAST(count(*) AS BIGINT) AS rows
FROM (SELECT source_filename,
             regexp_extract(source_filename, '(yellow|green|fhvhv|hvfhv|fhv)_tripdata_([0-9]{4})-([0-9]{2})', 1) AS s,
             regexp_extract(source_filename, '(yellow|green|fhvhv|hvfhv|fhv)_tripdata_([0-9]{4})-([0-9]{2})', 2) AS y,
             regexp_extract(source_filename, '(yellow|green|fhvhv|hvfhv|fhv)_tripdata_([0-9]{4})-([0-9]{2})', 3) AS mo
      FROM landing) x
GROUP BY 1, 2, 3, 4""",
    "normalize_to_landing": with_clause("landing") + """
SELECT source_kind, source_file_id, source_filename, source_row_number, service_type,
       pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
       CASE WHEN service_type = 'fhv' THEN NULL ELSE trip_distance END AS trip_distance,
       CASE WHEN service_type = 'fhv' THEN NULL ELSE total_amount END AS total_amount,
       dispatching_base_num, hvfhs_license_num
FROM landing""",
    "landing_rows_to_insert": with_clause("landing") + """
SELECT * FROM landing
WHERE NOT (pickup_datetime < TIMESTAMP '2024-01-16 00:00:00') OR pickup_datetime IS NULL""",
    "file_digests": """
SELECT parse_filename(filename) AS file_name, CAST(size AS BIGINT) AS size_bytes, sha256(content) AS sha256,
       CASE WHEN size = 0 THEN 'FAILED' ELSE 'DOWNLOADED' END AS status
FROM read_blob('/root/testdata/sf0.01/*.parquet')""",
    "landing_load_summary": with_clause("landing") + """
SELECT source_kind, source_file_id, source_filename, CAST(count(*) AS BIGINT) AS landing_rows
FROM landing GROUP BY 1, 2, 3""",
})

ORACLES["bronze_stream_ingest"] = with_clause("landing") + """
SELECT 'demo' AS source_kind, service_type, pickup_datetime, dropoff_datetime, pickup_location_id, dropoff_location_id,
       CASE WHEN service_type = 'fhv' THEN NULL ELSE trip_distance END AS trip_distance,
       CASE WHEN service_type = 'fhv' THEN NULL ELSE total_amount END AS total_amount
FROM landing"""

ORACLES["bronze_content_identity"] = with_clause("landing") + """
SELECT service_type, CAST(count(*) AS BIGINT) AS landing_rows, CAST(3 AS BIGINT) AS deliveries, CAST(6 AS BIGINT) AS names_a_content
FROM landing GROUP BY 1"""

#: Folder, what is in it, and the checks that fail there.
_FOLDERS = [("yellow", 1, "rows", []), ("green", 1, "rows", []), ("fhv", 1, "rows", []), ("fhvhv", 1, "rows", []),
            ("green", 2, "none", ["has_rows"]), ("fhvhv", 2, "rows", ["has_dropoff_location_id"]), ("yellow", 12, "rows", ["pickup_month_matches_path"]),
            *(("yellow", m, "unreadable", ["readable", "has_rows", "has_columns", "has_pickup_datetime", "has_dropoff_datetime",
                                           "has_pickup_location_id", "has_dropoff_location_id"]) for m in (2, 3))]
_CHECKS = ["readable", "has_rows", "has_columns", "has_pickup_datetime", "has_dropoff_datetime", "has_pickup_location_id",
           "has_dropoff_location_id", "path_names_service_and_month", "file_name_matches_path"]
_VERDICTS = ", ".join(f"('{s}', {m}, '{kind}', '{check}', '{'FAIL' if check in failed else 'PASS'}')"
                      for s, m, kind, failed in _FOLDERS
                      for check in _CHECKS + ["pickup_month_matches_path"] * (not failed or failed == ["pickup_month_matches_path"]))
ORACLES["validate_bronze"] = with_clause("landing") + f"""
SELECT v.service_type, CAST(2024 AS INTEGER) AS year, CAST(v.month AS INTEGER) AS month, v.check_name, v.status,
       CASE v.kind WHEN 'rows' THEN n.n WHEN 'none' THEN 0 END AS num_rows
FROM (VALUES {_VERDICTS}) AS v(service_type, month, kind, check_name, status)
LEFT JOIN (SELECT service_type, CAST(count(*) AS BIGINT) AS n FROM landing GROUP BY 1) n ON n.service_type = v.service_type"""

cte("file_days", ("landing",), """
SELECT service_type, CAST(pickup_datetime AS DATE) AS day, count(*) AS n, min(pickup_datetime) AS first_at
FROM landing WHERE pickup_datetime IS NOT NULL GROUP BY 1, 2""")
cte("file_states", ("file_days",), """
SELECT 'tlc' AS source_kind, service_type, CAST(year(day) AS SMALLINT) AS year, CAST(month(day) AS SMALLINT) AS month,
       service_type || '_tripdata_' || strftime(day, '%Y-%m-%d') || '.parquet' AS filename,
       CASE WHEN n % 5 = 0 THEN 'FAILED' ELSE 'PROCESSED' END AS status, CAST(n % 4 AS INTEGER) AS retry_count,
       CAST(first_at + (n % 4) * INTERVAL 1 HOUR AS TIMESTAMP) AS last_attempt_at,
       CASE WHEN n % 5 = 0 THEN 'attempt ' || (n % 4) WHEN n % 4 > 0 THEN 'attempt ' || (n % 4 - 1) END AS last_error,
       CASE WHEN n % 5 <> 0 THEN sha256(service_type || '|' || CAST(day AS VARCHAR) || '|' || n) END AS sha256,
       CASE WHEN n % 5 <> 0 THEN CAST(n * 100 AS BIGINT) END AS size_bytes, CASE WHEN n % 5 <> 0 THEN CAST(n AS BIGINT) END AS row_count,
       'run-0' AS first_run_id, 'run-' || (n % 4) AS last_run_id, CAST(first_at AS TIMESTAMP) AS created_at,
       CAST(first_at + (n % 4) * INTERVAL 1 HOUR + CASE WHEN n % 5 = 0 THEN INTERVAL 10 MINUTE ELSE INTERVAL 40 MINUTE END AS TIMESTAMP) AS updated_at
FROM file_days""")
ORACLES["file_states"] = select_from("file_states")
ORACLES["files_to_fetch"] = with_clause("file_states") + """
SELECT source_kind, service_type, year, month, filename,
       CASE WHEN status = 'PROCESSED' THEN 'SKIPPED' WHEN retry_count >= 2 THEN 'EXHAUSTED' ELSE 'RETRY' END AS action, retry_count
FROM file_states
UNION ALL
SELECT source_kind, service_type, year, CAST(month + 1 AS SMALLINT), filename, 'DOWNLOAD', 0 FROM file_states"""
ORACLES["recent_files"] = with_clause("file_states") + """
SELECT service_type, filename, status, retry_count, last_attempt_at FROM file_states ORDER BY updated_at DESC, filename LIMIT 50"""
cte("run_days", ("landing",), """
SELECT 'run-' || strftime(CAST(pickup_datetime AS DATE), '%Y%m%d') AS run_id, day(CAST(pickup_datetime AS DATE)) AS number,
       min(pickup_datetime) AS a, max(pickup_datetime) AS b
FROM landing WHERE pickup_datetime IS NOT NULL GROUP BY CAST(pickup_datetime AS DATE)""")
ORACLES["run_history"] = with_clause("run_days") + """
SELECT run_id, 'python' AS orchestrator, 'full' AS mode,
       CASE WHEN number % 5 = 0 THEN 'RUNNING' WHEN number % 3 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       CAST(a AS TIMESTAMP) AS started_at, CASE WHEN number % 5 <> 0 THEN CAST(b AS TIMESTAMP) END AS finished_at
FROM run_days ORDER BY started_at DESC"""
ORACLES["latest_model_status"] = with_clause("run_days") + """
SELECT run_id AS model_run_id,
       CASE WHEN number % 5 = 0 THEN 'RUNNING' WHEN number % 3 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS status
FROM run_days ORDER BY CASE WHEN number % 5 = 0 THEN a ELSE b END DESC LIMIT 1"""

# --- presentation -------------------------------------------------------------------------------
from farebox.operators.presentation import DASHBOARD_TABLES  # noqa: E402

_DASH_SOURCES = {
    "mart_mobility_overview": ORACLES["mart_mobility_overview"],
    "mart_service_comparison": ORACLES["mart_service_comparison"],
    "mart_driver_opportunity": ORACLES["mart_driver_opportunity"],
    "mart_congestion_proxy": ORACLES["mart_congestion_proxy"],
    "mart_profitability_scenario": ORACLES["mart_profitability_scenario"],
    "model_metrics": ORACLES["forecast_metrics_naive"],
    "predictions": select_from("naive"),
}
for _name, (_model, _cols) in DASHBOARD_TABLES.items():
    _c = ", ".join(_cols)
    _o = ", ".join(f"{c} ASC NULLS LAST" for c in _cols)
    ORACLES[f"dashboard_{_name}"] = f"SELECT {_c} FROM (\n{_DASH_SOURCES[_model]}\n) AS src ORDER BY {_o} LIMIT 100"

# --- tier 2 ----------------------------------------------------------------------------------------
_PRICED = "total_amount IS NOT NULL AND trip_distance > 0"
ORACLES["kpi_unit_economics"] = r6(with_clause("silver") + f"""
SELECT service_type, CAST(count(*) AS BIGINT) AS trip_count,
       CAST(count(total_amount) AS BIGINT) AS priced_trip_count,
       sum(total_amount) / nullif(count(total_amount), 0) AS amount_per_priced_trip,
       CAST(count(CASE WHEN {_PRICED} THEN 1 END) AS BIGINT) AS priced_trips_with_distance,
       sum(CASE WHEN {_PRICED} THEN total_amount END)
           / nullif(sum(CASE WHEN {_PRICED} THEN trip_distance END), 0) AS amount_per_mile,
       sum(CASE WHEN total_amount IS NOT NULL THEN total_amount END)
           / nullif(sum(CASE WHEN total_amount IS NOT NULL THEN duration_minutes END) / 60.0::DOUBLE, 0)
           AS amount_per_occupied_hour
FROM silver GROUP BY 1""", ["amount_per_priced_trip", "amount_per_mile", "amount_per_occupied_hour"])

ORACLES["borough_flows"] = with_clause("silver", "dim_zone") + """
SELECT pz.borough AS pickup_borough, dz.borough AS dropoff_borough, CAST(count(*) AS BIGINT) AS trip_count,
       pz.borough <> dz.borough AS cross_borough
FROM silver s JOIN dim_zone pz ON s.pickup_location_id = pz.taxi_zone_key
JOIN dim_zone dz ON s.dropoff_location_id = dz.taxi_zone_key
GROUP BY 1, 2"""

ORACLES["od_pairs_top"] = with_clause("silver", "dim_zone") + """
SELECT t.*, pz.zone_name AS pickup_zone_name, dz.zone_name AS dropoff_zone_name FROM (
  SELECT pickup_location_id AS pickup_taxi_zone_key, dropoff_location_id AS dropoff_taxi_zone_key,
         CAST(count(*) AS BIGINT) AS trip_count
  FROM silver GROUP BY 1, 2 ORDER BY trip_count DESC, 1, 2 LIMIT 20) t
LEFT JOIN dim_zone pz ON t.pickup_taxi_zone_key = pz.taxi_zone_key
LEFT JOIN dim_zone dz ON t.dropoff_taxi_zone_key = dz.taxi_zone_key"""


def _ranking(col: str) -> str:
    return with_clause("silver") + f"""
SELECT * FROM (
  SELECT service_type AS service_type_key, {col} AS taxi_zone_key, CAST(count(*) AS BIGINT) AS trip_count,
         CAST(dense_rank() OVER (PARTITION BY service_type ORDER BY count(*) DESC) AS INTEGER) AS zone_rank
  FROM silver GROUP BY 1, 2) r WHERE zone_rank <= 5"""


ORACLES["top_origins"] = _ranking("pickup_location_id")
ORACLES["top_destinations"] = _ranking("dropoff_location_id")


def _profile(group_expr: str, name: str) -> str:
    return r6(with_clause("hourly", "dim_date", "dim_time") + f"""
SELECT *, trips_per_cell / (sum(trip_count) OVER (PARTITION BY service_type_key)
                            / sum(observed_cells) OVER (PARTITION BY service_type_key)) AS demand_index
FROM (
  SELECT h.service_type_key, {group_expr} AS {name}, CAST(sum(h.trip_count) AS BIGINT) AS trip_count,
         CAST(count(*) AS BIGINT) AS observed_cells, sum(h.trip_count) / count(*) AS trips_per_cell
  FROM hourly h JOIN dim_date d ON h.date_key = d.date_key JOIN dim_time t ON h.hour_key = t.hour_key
  GROUP BY 1, 2) g""", ["trips_per_cell", "demand_index"])


ORACLES["demand_profile_day_period"] = _profile("t.day_period", "day_period")
ORACLES["demand_profile_weekend"] = _profile("CASE WHEN d.is_weekend THEN 'weekend' ELSE 'weekday' END", "weekend")

ORACLES["period_comparison"] = r6(with_clause("daily") + """
SELECT *, trip_count / nullif(active_days, 0) AS trips_per_day FROM (
  SELECT service_type_key,
         CASE WHEN date_key // 10000 BETWEEN 2018 AND 2019 THEN '2018_2019'
              WHEN date_key // 10000 BETWEEN 2020 AND 2021 THEN '2020_2021'
              WHEN date_key // 10000 BETWEEN 2022 AND 2025 THEN '2022_2025' ELSE 'other' END AS period,
         CAST(sum(trip_count) AS BIGINT) AS trip_count,
         CAST(count(DISTINCT date_key) AS INTEGER) AS active_days,
         sum(observed_trip_amount) AS observed_trip_amount,
         sum(average_duration_minutes * trip_count) / nullif(sum(trip_count), 0) AS weighted_average_duration_minutes
  FROM daily GROUP BY 1, 2) p""", ["observed_trip_amount", "weighted_average_duration_minutes", "trips_per_day"])

_PROFILE_COLS = [("source_kind", False), ("source_file_id", True), ("source_filename", False),
                 ("source_row_number", True), ("service_type", False), ("pickup_datetime", False),
                 ("dropoff_datetime", False), ("pickup_location_id", True), ("dropoff_location_id", True),
                 ("trip_distance", True), ("total_amount", True), ("dispatching_base_num", False),
                 ("hvfhs_license_num", False), ("duration_minutes", True)]
ORACLES["quality_profile"] = r6(with_clause("stg") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) AS BIGINT) AS rows, "
    f"CAST(count(*) - count({c}) AS BIGINT) AS null_count, "
    f"(count(*) - count({c})) * 100.0::DOUBLE / nullif(count(*), 0) AS null_pct, "
    + (f"CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value"
       if num else "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value")
    + " FROM stg" for c, num in _PROFILE_COLS), ["null_pct", "min_value", "max_value"])

ORACLES["valid_share"] = r6(with_clause("stg") + """
SELECT service_type, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) FILTER (WHERE invalid_reason IS NULL) AS BIGINT) AS valid_rows,
       count(*) FILTER (WHERE invalid_reason IS NULL) * 100.0::DOUBLE / count(*) AS valid_pct
FROM stg GROUP BY 1""", ["valid_pct"])

ORACLES["file_month_coherence"] = with_clause("landing") + """
SELECT source_kind, source_file_id, source_filename, CAST(count(*) AS BIGINT) AS rows,
       CAST(count(pickup_datetime) AS BIGINT) AS rows_with_pickup,
       CAST(count(CASE WHEN year(pickup_datetime) <> y OR month(pickup_datetime) <> m THEN 1 END) AS BIGINT)
           AS outside_month,
       CAST(count(CASE WHEN CAST(pickup_datetime AS DATE) < make_date(y, m, 1) - 1
                        OR CAST(pickup_datetime AS DATE) > CAST(make_date(y, m, 1) + INTERVAL 1 MONTH AS DATE)
                       THEN 1 END) AS BIGINT) AS outside_tolerance
FROM (SELECT *, CAST(regexp_extract(source_filename, '_tripdata_([0-9]{4})-([0-9]{2})', 1) AS INTEGER) AS y,
             CAST(regexp_extract(source_filename, '_tripdata_([0-9]{4})-([0-9]{2})', 2) AS INTEGER) AS m
      FROM landing) l
GROUP BY 1, 2, 3"""

_SCEN = [("base", 0.20, 0.35, 1.50), ("high_cost", 0.25, 0.50, 2.00), ("low_cost", 0.10, 0.25, 1.00)]
ORACLES["scenario_grid"] = r6(with_clause("daily") + "\n" + "\nUNION ALL\n".join(f"""
SELECT zone_day_service_key, date_key, taxi_zone_key, service_type_key, '{n}' AS scenario, trip_count,
       observed_trip_amount,
       CASE WHEN revenue_observation_count > 0 THEN
            observed_trip_amount - observed_trip_amount * {c}::DOUBLE
            - coalesce(average_trip_distance, 0.0::DOUBLE) * trip_count * {v}::DOUBLE
            - trip_count * {f}::DOUBLE END AS estimated_net_contribution,
       (coalesce(average_trip_distance, 0.0::DOUBLE) * {v}::DOUBLE + {f}::DOUBLE)
           / nullif(1.0::DOUBLE - {c}::DOUBLE, 0) AS break_even_amount_per_trip
FROM daily""" for n, c, v, f in _SCEN), ["observed_trip_amount", "estimated_net_contribution",
                                         "break_even_amount_per_trip"])

ORACLES["enrich_weather"] = r6(with_clause("hourly") + """
SELECT h.*, w.temperature, w.observations
FROM hourly h LEFT JOIN (
  SELECT CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key, CAST(hour(ts) AS SMALLINT) AS hour_key, max(value) AS temperature,
         CAST(count(*) AS BIGINT) AS observations
  FROM events WHERE hour(ts) % 2 = 0 GROUP BY 1, 2) w ON w.date_key = h.date_key AND w.hour_key = h.hour_key""", HOURLY_DOUBLES + ["temperature"])

_STATE_RULES = [("source_kind", "source_kind NOT IN ('demo', 'tlc')"), ("service_type", "service_type NOT IN ('yellow', 'green', 'fhv', 'fhvhv')"),
                ("year", "NOT year BETWEEN 2009 AND 2100"), ("month", "NOT month BETWEEN 1 AND 12"), ("size_bytes", "size_bytes < 0"),
                ("row_count", "row_count < 0"),
                ("status", "status NOT IN ('DISCOVERED', 'DOWNLOADING', 'DOWNLOADED', 'VALIDATED', 'PROCESSED', 'FAILED', 'QUARANTINED')"),
                ("foreign_key_first_run_id", "false"), ("foreign_key_last_run_id", "last_run_id = 'run-3'")]
ORACLES["control_foreign_keys"] = with_clause("file_states") + "\n" + "\nUNION ALL\n".join(
    f"SELECT 'ingestion_files' AS table_name, '{name}' AS constraint_name, CAST(count(*) FILTER (WHERE {rule}) AS BIGINT) AS failures FROM file_states"
    for name, rule in _STATE_RULES) + """
UNION ALL SELECT 'ingestion_files', 'unique_key', CAST(count(*) AS BIGINT)
FROM (SELECT 1 FROM file_states GROUP BY source_kind, service_type, year, month, filename HAVING count(*) > 1) d"""

ORACLES["enrich_calendar"] = r6(with_clause("hourly", "dim_date") + """
SELECT h.*, CASE WHEN d.month IN (12, 1, 2) THEN 'winter' WHEN d.month IN (3, 4, 5) THEN 'spring'
                 WHEN d.month IN (6, 7, 8) THEN 'summer' WHEN d.month IN (9, 10, 11) THEN 'autumn' END AS season,
       false AS is_holiday, false AS is_holiday_eve
FROM hourly h LEFT JOIN dim_date d ON h.date_key = d.date_key""", HOURLY_DOUBLES)

ORACLES["forecast_error_by_service"] = r6(with_clause("naive") + """
SELECT model_name, horizon_hours, service_type AS service,
       count(*) AS sample_count, avg(abs(actual_demand - predicted_demand)) AS mae,
       sum(abs(actual_demand - predicted_demand)) / nullif(sum(abs(actual_demand)), 0) AS wape,
       avg(CASE WHEN actual_demand <> 0 THEN abs(actual_demand - predicted_demand) / abs(actual_demand) END) AS mape
FROM naive GROUP BY 1, 2, 3""", ["mae", "wape", "mape"])

# --- round trips, build, control constraints ---------------------------------------------------------
ORACLES["json_bronze_round_trip"] = with_clause("landing") + """
SELECT service_type, CAST(count(*) AS BIGINT) AS rows, CAST(count(dropoff_datetime) AS BIGINT) AS dropoffs,
       CAST(count(CASE WHEN service_type = 'fhv' THEN NULL ELSE total_amount END) AS BIGINT) AS amounts,
       CAST(sum(source_row_number) AS BIGINT) AS row_number_sum
FROM landing GROUP BY 1"""

ORACLES["zone_lookup_csv_round_trip"] = select_from("dim_zone")

ORACLES["warehouse_build"] = ORACLES["data_quality_suite"]

ORACLES["control_constraints_manifest"] = with_clause("manifest_merged") + """
SELECT 'ingestion_files' AS table_name, constraint_name, CAST(failures AS BIGINT) AS failures FROM (
  SELECT 'source_kind' AS constraint_name, count(*) FILTER (WHERE source_kind NOT IN ('demo', 'tlc')) AS failures FROM manifest_merged
  UNION ALL SELECT 'service_type', count(*) FILTER (WHERE service_type NOT IN ('yellow', 'green', 'fhv', 'fhvhv')) FROM manifest_merged
  UNION ALL SELECT 'year', count(*) FILTER (WHERE NOT (year BETWEEN 2009 AND 2100)) FROM manifest_merged
  UNION ALL SELECT 'month', count(*) FILTER (WHERE NOT (month BETWEEN 1 AND 12)) FROM manifest_merged
  UNION ALL SELECT 'size_bytes', count(*) FILTER (WHERE size_bytes < 0) FROM manifest_merged
  UNION ALL SELECT 'row_count', count(*) FILTER (WHERE row_count < 0) FROM manifest_merged
  UNION ALL SELECT 'status', count(*) FILTER (WHERE status NOT IN ('DISCOVERED', 'DOWNLOADING', 'DOWNLOADED',
                   'VALIDATED', 'PROCESSED', 'FAILED', 'QUARANTINED')) FROM manifest_merged
  UNION ALL SELECT 'unique_key', count(*) FROM (SELECT 1 FROM manifest_merged
                   GROUP BY source_kind, service_type, year, month, filename HAVING count(*) > 1) d) c"""
ORACLES["hourly_panel_ordered"] = select_from("panel", tail="ORDER BY service_type, taxi_zone_key, target_timestamp")

ORACLES["demand_profile_hour"] = _profile("h.hour_key", "hour_key")
ORACLES["demand_profile_month"] = _profile("d.month", "month")
ORACLES["forecast_error_by_zone"] = r6(with_clause("naive") + """
SELECT model_name, horizon_hours, taxi_zone_key AS zone,
       count(*) AS sample_count, avg(abs(actual_demand - predicted_demand)) AS mae,
       sum(abs(actual_demand - predicted_demand)) / nullif(sum(abs(actual_demand)), 0) AS wape,
       avg(CASE WHEN actual_demand <> 0 THEN abs(actual_demand - predicted_demand) / abs(actual_demand) END) AS mape
FROM naive GROUP BY 1, 2, 3""", ["mae", "wape", "mape"])

ORACLES["duplicate_profile"] = with_clause("landing") + """
SELECT service_type, CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_keys, CAST(sum(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT service_type, source_kind, source_file_id, source_row_number, count(*) AS n
      FROM (SELECT * FROM landing UNION ALL SELECT * FROM landing) d GROUP BY 1, 2, 3, 4) k
GROUP BY 1"""

ORACLES["inventory_actions"] = with_clause("inventory", "manifest_merged") + """
SELECT i.source_kind, i.service_type, CAST(i.year AS SMALLINT) AS year, CAST(i.month AS SMALLINT) AS month,
       i.filename, i.source_url,
       CASE WHEN EXISTS (SELECT 1 FROM manifest_merged m WHERE m.status IN ('VALIDATED', 'PROCESSED')
                         AND m.source_kind = i.source_kind AND m.service_type = i.service_type
                         AND m.year = i.year AND m.month = i.month AND m.filename = i.filename)
            THEN 'SKIPPED' ELSE 'DOWNLOAD' END AS action
FROM inventory i"""

_PROBABILITIES = (0.01, 0.5, 0.99)
ORACLES["quality_percentiles"] = r6(with_clause("stg") + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {p}::DOUBLE AS probability, max(v) FILTER (WHERE r = ceil({p}::DOUBLE * n)) AS percentile FROM "
    f"(SELECT CAST({c} AS DOUBLE) AS v, row_number() OVER (ORDER BY {c}) AS r, count(*) OVER () AS n FROM stg WHERE {c} IS NOT NULL)"
    for c in ("trip_distance", "total_amount", "duration_minutes") for p in _PROBABILITIES), ["percentile"])
