"""Ordered build of all models, with tests gating downstream models.

Staging is written once as a table partitioned by a quarantine flag and
service_type: landing is scanned a single time, and silver / quarantine are
views whose filters prune to their partitions.  Dimensions and facts are
written as Parquet under ``target_dir`` and re-read, so later models and tests
scan materialized, column-pruned files instead of recomputing lineage; marts
stay lazy views.  Silver is read once for aggregates: the hourly partials feed
both aggregate facts and the date dimension.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import checks as chk
from farebox.operators import dimensions as dims
from farebox.operators import facts, marts, silver
from farebox.schemas import DEFAULT_SCENARIO
from farebox.session import checkpoint_dir
from farebox.sources.versions import swap_in


@dataclass(frozen=True)
class Model:
    name: str
    layer: str                       # 'view' | 'table'
    deps: tuple[str, ...]
    fn: Callable[..., DataFrame]
    partition_by: tuple[str, ...] = ()
    hidden: tuple[str, ...] = ()     # stored (e.g. partition flags) but not in the user-facing view


# Staging is stored with a boolean flag so that silver / quarantine prune to their
# partitions while each write task emits at most 2 files per service (a
# partition per quarantine reason would scatter ~10 small files per task).
QUARANTINE_FLAG = "_quarantined"


def model_graph(spark: SparkSession, scenario: dict | None = None) -> list[Model]:
    sc = scenario or {}
    return [
        # staging is written once (one pass over landing), partitioned by the
        # quarantine flag and service; silver and quarantine are pruned views
        Model("stg_trip_records", "table", ("landing",),
              lambda land: silver.stg_trip_records(land).withColumn(
                  QUARANTINE_FLAG, F.col("invalid_reason").isNotNull()),
              (QUARANTINE_FLAG, "service_type"), hidden=(QUARANTINE_FLAG,)),
        Model("trips", "view", ("stg_trip_records",),
              lambda stg: silver.silver_trips(stg.filter(~F.col(QUARANTINE_FLAG)))),
        Model("trip_quarantine", "view", ("stg_trip_records",),
              lambda stg: silver.trip_quarantine(stg.filter(F.col(QUARANTINE_FLAG))).drop(QUARANTINE_FLAG)),
        Model("dim_taxi_zone", "table", ("taxi_zone_lookup",), dims.dim_taxi_zone),
        Model("dim_service_type", "table", (), lambda: dims.dim_service_type(spark)),
        Model("dim_time", "table", (), lambda: dims.dim_time(spark)),
        Model("zone_hour_partials", "table", ("trips",), facts.zone_hour_partials),
        Model("dim_date", "table", ("zone_hour_partials",),
              lambda p: dims.dim_date_from_dates(p, "pickup_date")),
        Model("fact_trip", "table", ("trips",), facts.fact_trip, ("service_type_key",)),
        Model("fact_zone_hourly_demand", "table", ("zone_hour_partials",), facts.fact_zone_hourly_demand),
        Model("fact_zone_daily_performance", "table", ("zone_hour_partials",), facts.fact_zone_daily_performance),
        Model("mart_mobility_overview", "view", ("fact_zone_daily_performance", "dim_service_type"),
              marts.mart_mobility_overview),
        Model("mart_service_comparison", "view", ("dim_service_type", "fact_zone_daily_performance"),
              marts.mart_service_comparison),
        Model("mart_driver_opportunity", "view", ("fact_zone_hourly_demand", "dim_taxi_zone"),
              marts.mart_driver_opportunity),
        Model("mart_congestion_proxy", "view", ("fact_zone_hourly_demand", "dim_taxi_zone"),
              marts.mart_congestion_proxy),
        Model("mart_profitability_scenario", "view", ("fact_zone_daily_performance", "dim_taxi_zone"),
              lambda d, z: marts.mart_profitability_scenario(d, z, **sc)),
    ]


def materialize(df: DataFrame, name: str, layer: str, target_dir: str,
                partition_by: tuple[str, ...] = (), hidden: tuple[str, ...] = ()) -> DataFrame:
    """View → temp view (lazy); table → a new version, made current when it is whole, then read back.

    ``hidden`` columns stay on the returned DataFrame (downstream models can
    prune on them) but not on the registered view.
    """
    spark = df.sparkSession
    if layer == "view":
        df.createOrReplaceTempView(name)
        return df
    spark.sparkContext.setJobDescription(f"materialize {name}")
    out = swap_in(df, f"{target_dir.rstrip('/')}/{name}", partition_by)
    out.drop(*hidden).createOrReplaceTempView(name)
    return out


@dataclass
class BuildResult:
    models: dict[str, DataFrame] = field(default_factory=dict)
    status: dict[str, str] = field(default_factory=dict)
    tests: list[dict] = field(default_factory=list)
    seconds: dict[str, float] = field(default_factory=dict)
    run_id: str | None = None


def _record_run(spark: SparkSession, control_dir: str, run_id: str, mode: str, status: str,
                error: str | None = None, counters: tuple | None = None, dates: tuple = (None, None),
                started: dt.datetime | None = None, parameters: dict | None = None) -> None:
    """Append one pipeline_runs row (append-only: the latest row per run wins).

    ``counters`` = (rows_read, rows_valid, rows_rejected) and ``dates`` = first
    and last pickup date of the landed rows, both on the final row.
    """
    from farebox import __version__
    from farebox.sources.landing import write_table
    read, valid, rejected = counters or (None, None, None)
    row = spark.createDataFrame(
        [(run_id, "python", mode, status, __version__, error, read, valid, rejected, *dates, started,
          json.dumps(parameters or {}, sort_keys=True))],
        "run_id string, orchestrator string, mode string, status string, code_version string, "
        "error_message string, rows_read long, rows_valid long, rows_rejected long, start_date date, "
        "end_date date, started_at timestamp, parameters string",
    ).withColumn("recorded_at", F.current_timestamp())
    write_table(row, f"{control_dir.rstrip('/')}/pipeline_runs")


def build(spark: SparkSession, landing: DataFrame, zone_lookup: DataFrame,
          target_dir: str | None = None, select: list[str] | None = None,
          run_tests: bool = True, scenario: dict | None = None, max_parallel: int = 4,
          control_dir: str | None = None, mode: str = "demo") -> BuildResult:
    """Build all (or the selected and their upstream) models in dependency order.

    Tests run as soon as their models exist; a failing test marks every
    downstream model SKIPPED (like a failing test in a warehouse build).
    With ``control_dir`` the run is recorded in append-only control tables:
    ``pipeline_runs`` (RUNNING, then SUCCEEDED / FAILED), ``pipeline_tasks`` (one
    row per model) and ``data_quality_results`` (one row per check).
    """
    if control_dir is None:
        return _build(spark, landing, zone_lookup, target_dir, select, run_tests, scenario, max_parallel)
    import uuid
    from farebox.sources.landing import write_table
    run_id = str(uuid.uuid4())
    known = {"started": dt.datetime.now(dt.timezone.utc),
             "parameters": {"select": select or "all", "run_tests": run_tests, "scenario": scenario or DEFAULT_SCENARIO}}
    _record_run(spark, control_dir, run_id, mode, "RUNNING", **known)
    try:
        res = _build(spark, landing, zone_lookup, target_dir, select, run_tests, scenario, max_parallel)
    except Exception as exc:
        _record_run(spark, control_dir, run_id, mode, "FAILED", str(exc), **known)
        raise
    # a model that was built but failed its tests is a failed task
    tasks = [(run_id, name, "FAILED" if status == "TESTS_FAILED" else status, float(res.seconds.get(name, 0.0))) for name, status in res.status.items()]
    write_table(spark.createDataFrame(tasks, "run_id string, task_name string, status string, seconds double"),
                f"{control_dir.rstrip('/')}/pipeline_tasks")
    if res.tests:
        results = [(run_id, t["check_name"], t["status"], str(t["failures"]), "0") for t in res.tests]
        write_table(spark.createDataFrame(results, "run_id string, check_name string, status string, "
                                                   "observed_value string, expected_value string")
                    .withColumn("checked_at", F.current_timestamp()),
                    f"{control_dir.rstrip('/')}/data_quality_results")
    failed = any(t["status"] == "FAIL" for t in res.tests)
    counters, dates = None, (None, None)
    stg = res.models.get("stg_trip_records")
    if stg is not None and QUARANTINE_FLAG in stg.columns:
        # one aggregation on the partition flag of the stored staging table
        c = stg.agg(F.count(F.lit(1)).alias("n"),
                    F.count(F.when(~F.col(QUARANTINE_FLAG), 1)).alias("v"),
                    F.to_date(F.min("pickup_datetime")).alias("a"), F.to_date(F.max("pickup_datetime")).alias("b")).first()
        counters, dates = (c["n"], c["v"], c["n"] - c["v"]), (c["a"], c["b"])
    _record_run(spark, control_dir, run_id, mode, "FAILED" if failed else "SUCCEEDED",
                "data-quality checks failed" if failed else None, counters, dates, **known)
    res.run_id = run_id
    return res


def _build(spark: SparkSession, landing: DataFrame, zone_lookup: DataFrame,
           target_dir: str | None, select: list[str] | None,
           run_tests: bool, scenario: dict | None, max_parallel: int) -> BuildResult:
    target_dir = target_dir or f"{checkpoint_dir(spark).rstrip('/')}/warehouse"
    graph = model_graph(spark, scenario)
    by_name = {m.name: m for m in graph}
    wanted = set(by_name) if not select else set()
    if select:
        stack = list(select)
        while stack:
            n = stack.pop()
            if n in by_name and n not in wanted:
                wanted.add(n)
                stack.extend(by_name[n].deps)
    res = BuildResult()
    res.models["landing"] = landing
    res.models["taxi_zone_lookup"] = zone_lookup
    suite = chk.default_suite()
    blocked: set[str] = set()
    done: set[str] = set()

    # silver and quarantine are row filters of staging keeping trip_id: their
    # uniqueness checks are answered with staging's in one shuffle
    family = ("stg_trip_records", "trip_id", {"stg_trip_records": None,
                                              "trips": F.col("invalid_reason").isNull(),
                                              "trip_quarantine": F.col("invalid_reason").isNotNull()})

    def run_ready_checks() -> None:
        fam_ready = family[0] in res.models

        def ready(c: chk.Check) -> bool:
            if fam_ready and c.test == "unique" and c.column == family[1] and c.model in family[2]:
                return True
            need = c.model.split(",") + ([c.parent] if c.parent else [])
            return all(x in res.models for x in need)
        todo = [c for c in suite.checks if c.name not in done and ready(c)]
        if not (run_tests and todo):
            return
        rows = chk.run_checks(res.models, chk.Suite(todo), [family] if fam_ready else None).collect()
        done.update(c.name for c in todo)
        res.tests.extend(r.asDict() for r in rows)
        for r in rows:
            if r["status"] == "FAIL":
                for name in r["model"].split(","):
                    blocked.add(name)
                    if name in res.status:
                        res.status[name] = "TESTS_FAILED"

    # waves: models whose inputs are all available; a wave's models are
    # independent, so their writes run as concurrent Spark jobs, and the
    # wave's tests run as one job before the next wave starts
    run_ready_checks()                      # source / seed tests
    pending = [m for m in graph if m.name in wanted]
    while pending:
        wave = [m for m in pending if all(d in res.models or d in blocked or d in res.status
                                          for d in m.deps)]
        if not wave:
            raise ValueError(f"unresolvable dependencies: {[m.name for m in pending]}")
        pending = [m for m in pending if m not in wave]
        runnable = []
        for m in wave:
            if any(d in blocked or res.status.get(d) == "SKIPPED" for d in m.deps):
                res.status[m.name] = "SKIPPED"
                blocked.add(m.name)
            else:
                runnable.append(m)

        def run(m: Model) -> tuple[str, DataFrame, float]:
            t0 = time.time()
            df = m.fn(*[res.models[d] for d in m.deps])
            return m.name, materialize(df, m.name, m.layer, target_dir, m.partition_by, m.hidden), time.time() - t0

        with ThreadPoolExecutor(max_workers=max(1, min(len(runnable), max_parallel))) as pool:
            for name, df, secs in pool.map(run, runnable):
                res.models[name] = df
                # a model whose tests already failed (answered early through its base) is built but flagged
                res.status[name] = "TESTS_FAILED" if name in blocked else "SUCCEEDED"
                res.seconds[name] = round(secs, 3)
        t0 = time.time()
        run_ready_checks()
        res.seconds[f"tests_wave_{len(res.seconds)}"] = round(time.time() - t0, 3)
    return res
