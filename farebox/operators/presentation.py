"""Presentation queries: dashboard tables, run/file status listings.

Dashboard tables are raw projections limited to 100 rows; a deterministic
order over the listed columns makes them reproducible (a global top-k: each
partition keeps its best 100 before the final merge).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DASHBOARD_ROW_LIMIT = 100

# --- fixed values: dashboard charts (source model, columns) -------------------
DASHBOARD_TABLES = {
    "daily_overview": ("mart_mobility_overview",
                       ["date_key", "service_type_name", "trip_count", "active_pickup_zones", "observed_trip_amount"]),
    "service_comparison": ("mart_service_comparison",
                           ["service_type_name", "trip_count", "active_days", "active_pickup_zones",
                            "observed_trip_amount"]),
    "relative_demand": ("mart_driver_opportunity",
                        ["date_key", "hour_key", "borough", "zone_name", "service_type_key", "trip_count",
                         "relative_demand_score"]),
    "congestion_proxy": ("mart_congestion_proxy",
                         ["date_key", "hour_key", "borough", "zone_name", "service_type_key", "average_speed_mph",
                          "minutes_per_mile_proxy"]),
    "opportunity_per_hour": ("mart_driver_opportunity",
                             ["date_key", "hour_key", "zone_name", "service_type_key", "trip_count",
                              "observed_amount_per_occupied_hour"]),
    "net_contribution": ("mart_profitability_scenario",
                         ["date_key", "zone_name", "service_type_key", "trip_count", "observed_trip_amount",
                          "estimated_net_contribution_scenario"]),
    "model_metrics": ("model_metrics", ["model_name", "horizon_hours", "mae", "rmse", "wape", "r2", "is_selected"]),
    "actual_vs_predicted": ("predictions",
                            ["target_timestamp", "service_type", "taxi_zone_key", "horizon_hours", "model_name",
                             "actual_demand", "predicted_demand"]),
}
# -----------------------------------------------------------------------------


def dashboard_table(name: str, source: DataFrame, limit: int = DASHBOARD_ROW_LIMIT) -> DataFrame:
    _, cols = DASHBOARD_TABLES[name]
    return source.select(*cols).orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(limit)


def latest_model_status(runs: DataFrame) -> DataFrame:
    """Status of the newest run (``ORDER BY started_at DESC LIMIT 1`` on an append-only run table)."""
    ts = "recorded_at" if "recorded_at" in runs.columns else "started_at"
    return runs.orderBy(F.desc(ts)).limit(1).select("model_run_id", "status")


def landing_rows_for_file(landing: DataFrame, filename: str) -> DataFrame:
    return landing.filter(F.col("source_filename") == filename).agg(F.count(F.lit(1)).alias("landing_rows"))


def run_history(runs: DataFrame) -> DataFrame:
    """One row per run, newest first: start = first record, finish/status = last record
    (append-only run table: RUNNING, then SUCCEEDED / FAILED)."""
    if "recorded_at" not in runs.columns:
        cols = [c for c in ("run_id", "orchestrator", "mode", "status", "started_at", "finished_at")
                if c in runs.columns]
        return runs.select(*cols).orderBy(F.desc("started_at"))
    last = F.max_by(F.struct("status", "orchestrator", "mode"), "recorded_at")
    return runs.groupBy("run_id").agg(
        last.alias("l"), F.min("recorded_at").alias("started_at"), F.max("recorded_at").alias("last_at"),
        F.count(F.lit(1)).alias("n"),
    ).select("run_id", "l.orchestrator", "l.mode", "l.status", "started_at",
             F.when(F.col("l.status") != "RUNNING", F.col("last_at")).alias("finished_at")
             ).orderBy(F.desc("started_at"))


def recent_files(states: DataFrame, k: int = 50) -> DataFrame:
    """File states (of :func:`farebox.sources.file_states.current_states`), most recently updated first (top-k)."""
    return (states.orderBy(F.col("updated_at").desc_nulls_last(), "filename").limit(k)
            .select("service_type", "filename", "status", "retry_count", "last_attempt_at"))


def ordered_panel(panel: DataFrame, ts_col: str = "target_timestamp") -> DataFrame:
    """Panel in (service, zone, time) order — a range-partitioned global sort, only at output."""
    return panel.orderBy("service_type", "taxi_zone_key", ts_col)
