"""Data-quality checks.

Each ``check_*`` returns the *failing rows* as a lazy DataFrame (empty = pass),
with the same row semantics as the generic SQL tests they mirror:

* not_null        — rows whose column is NULL
* unique          — non-NULL values occurring more than once, with ``n_records``
* accepted_values — grouped values outside the list (NULL passes), with ``n_records``
* relationships   — child rows whose non-NULL key has no parent row

:func:`run_checks` evaluates a whole suite with one scan of each model and one
shuffle in all: a model's rows are turned into (check, key) pairs of all checks
that read it (as child or as parent), and a partially aggregated count by pair
answers every check.  A pair that a third of all rows share ships one row a map
task.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    return (df.select(F.col(column).alias("unique_field"))
            .filter(F.col("unique_field").isNotNull())
            .groupBy("unique_field").agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def check_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return (df.groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(~F.col("value_field").isin(list(values))))


def parent_keys(parent: DataFrame, field_: str) -> DataFrame:
    """Distinct parent keys."""
    return parent.select(F.col(field_).alias("to_field")).distinct()


def check_relationships(child: DataFrame, column: str, parent: DataFrame, field_: str,
                        keys: DataFrame | None = None) -> DataFrame:
    keys = keys if keys is not None else parent_keys(parent, field_)
    return (child.select(F.col(column).alias("from_field"))
            .filter(F.col("from_field").isNotNull())
            .join(keys, F.col("from_field") == F.col("to_field"), "left_anti"))


def negative_measures() -> Column:
    return (F.col("duration_minutes") < 0) | (F.col("trip_distance") < 0) | (F.col("average_speed_mph") < 0)


def inconsistent_counts() -> Column:
    return ((F.col("trip_count") <= 0) | (F.col("revenue_observation_count") < 0)
            | (F.col("revenue_observation_count") > F.col("trip_count")))


def negative_duration() -> Column:
    return F.col("duration_minutes") < 0


def check_non_negative_measures(fact_trip: DataFrame) -> DataFrame:
    return fact_trip.filter(negative_measures())


def check_gold_counts(hourly: DataFrame) -> DataFrame:
    return hourly.filter(inconsistent_counts())


def check_totals_reconcile(trips: DataFrame, daily: DataFrame) -> DataFrame:
    """One row (silver_count, gold_count) when silver and the daily fact disagree.

    Both totals come from a single aggregation over the union of the two
    inputs (no join): each side contributes only its own counter.
    """
    both = trips.select(F.lit(1).cast("long").alias("s"), F.lit(0).cast("long").alias("g")) \
        .unionByName(daily.select(F.lit(0).cast("long").alias("s"), F.col("trip_count").cast("long").alias("g")))
    totals = both.agg(F.sum("s").alias("silver_count"), F.sum("g").alias("gold_count"),
                      F.count(F.when(F.col("s") == 0, 1)).alias("gold_rows"))
    # an empty daily fact has no total: NULL differs from nothing, so empty inputs pass
    gold = F.when(F.col("gold_rows") > 0, F.col("gold_count"))
    return (totals.select(F.coalesce("silver_count", F.lit(0)).alias("silver_count"), gold.alias("gold_count"))
            .filter(F.col("silver_count") != F.col("gold_count")))


def check_non_negative_duration(trips: DataFrame) -> DataFrame:
    return trips.filter(negative_duration()).select("trip_id")


# --- suites ------------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    model: str
    test: str                      # not_null | unique | accepted_values | relationships | singular
    column: str | None = None
    values: tuple = ()
    parent: str | None = None
    parent_field: str | None = None
    name_override: str | None = None

    @property
    def name(self) -> str:
        if self.name_override:
            return self.name_override
        if self.test == "relationships":
            return f"relationships__{self.model}__{self.column}__{self.parent}"
        return f"{self.test}__{self.model}__{self.column}"


@dataclass
class Suite:
    checks: list[Check] = field(default_factory=list)

    def not_null(self, model, *cols):
        self.checks += [Check(model, "not_null", c) for c in cols]
        return self

    def unique(self, model, *cols):
        self.checks += [Check(model, "unique", c) for c in cols]
        return self

    def accepted(self, model, col, values):
        self.checks.append(Check(model, "accepted_values", col, tuple(values)))
        return self

    def rel(self, model, col, parent, parent_field):
        self.checks.append(Check(model, "relationships", col, parent=parent, parent_field=parent_field))
        return self

    def singular(self, name, *models):
        self.checks.append(Check(",".join(models), "singular", name_override=name))
        return self


#: Singular checks: the models they read, and which rows fail (None: totals that must agree).
SINGULAR: dict[str, tuple[tuple[str, ...], Callable[[], Column] | None]] = {
    "fact_trip_measures_are_non_negative": (("fact_trip",), negative_measures),
    "gold_counts_are_consistent": (("fact_zone_hourly_demand",), inconsistent_counts),
    "gold_trip_totals_reconcile": (("trips", "fact_zone_daily_performance"), None),
    "trips_have_non_negative_duration": (("trips",), negative_duration),
}


# --- fixed values: the warehouse's 79 generic + 4 singular tests -----------------
def default_suite() -> Suite:
    """The warehouse's 79 generic + 4 singular tests."""
    from farebox.schemas import DAY_PERIODS, SERVICES
    services = list(SERVICES)
    periods = [p[0] for p in DAY_PERIODS]
    s = Suite()
    s.not_null("landing", "source_file_id", "source_row_number", "service_type")
    s.accepted("landing", "service_type", services)
    s.not_null("stg_trip_records", "trip_id").unique("stg_trip_records", "trip_id")
    s.not_null("stg_trip_records", "service_type").accepted("stg_trip_records", "service_type", services)
    s.not_null("stg_trip_records", "source_file_id")
    s.not_null("trips", "trip_id").unique("trips", "trip_id")
    s.not_null("trips", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")
    s.not_null("trip_quarantine", "trip_id").unique("trip_quarantine", "trip_id")
    s.not_null("trip_quarantine", "invalid_reason")
    s.not_null("taxi_zone_lookup", "location_id").unique("taxi_zone_lookup", "location_id")
    s.not_null("taxi_zone_lookup", "borough", "zone_name")
    s.not_null("dim_service_type", "service_type_key").unique("dim_service_type", "service_type_key")
    s.accepted("dim_service_type", "service_type_key", services)
    s.not_null("dim_taxi_zone", "taxi_zone_key").unique("dim_taxi_zone", "taxi_zone_key")
    s.not_null("dim_taxi_zone", "borough", "zone_name")
    s.not_null("dim_date", "date_key").unique("dim_date", "date_key")
    s.not_null("dim_date", "full_date").unique("dim_date", "full_date")
    s.not_null("dim_time", "hour_key").unique("dim_time", "hour_key")
    s.not_null("dim_time", "day_period").accepted("dim_time", "day_period", periods)
    ft = "fact_trip"
    s.not_null(ft, "trip_id").unique(ft, "trip_id")
    s.not_null(ft, "pickup_date_key").rel(ft, "pickup_date_key", "dim_date", "date_key")
    s.not_null(ft, "pickup_hour_key").rel(ft, "pickup_hour_key", "dim_time", "hour_key")
    s.not_null(ft, "pickup_taxi_zone_key").rel(ft, "pickup_taxi_zone_key", "dim_taxi_zone", "taxi_zone_key")
    s.not_null(ft, "dropoff_taxi_zone_key").rel(ft, "dropoff_taxi_zone_key", "dim_taxi_zone", "taxi_zone_key")
    s.not_null(ft, "service_type_key").rel(ft, "service_type_key", "dim_service_type", "service_type_key")
    h = "fact_zone_hourly_demand"
    s.not_null(h, "zone_hour_service_key").unique(h, "zone_hour_service_key")
    s.not_null(h, "date_key").rel(h, "date_key", "dim_date", "date_key")
    s.not_null(h, "hour_key").rel(h, "hour_key", "dim_time", "hour_key")
    s.not_null(h, "taxi_zone_key").rel(h, "taxi_zone_key", "dim_taxi_zone", "taxi_zone_key")
    s.not_null(h, "service_type_key").rel(h, "service_type_key", "dim_service_type", "service_type_key")
    s.not_null(h, "trip_count")
    d = "fact_zone_daily_performance"
    s.not_null(d, "zone_day_service_key").unique(d, "zone_day_service_key")
    s.not_null(d, "date_key").rel(d, "date_key", "dim_date", "date_key")
    s.not_null(d, "taxi_zone_key").rel(d, "taxi_zone_key", "dim_taxi_zone", "taxi_zone_key")
    s.not_null(d, "service_type_key").rel(d, "service_type_key", "dim_service_type", "service_type_key")
    s.not_null(d, "trip_count")
    s.not_null("mart_mobility_overview", "date_key", "service_type_key")
    s.not_null("mart_service_comparison", "service_type_key").unique("mart_service_comparison", "service_type_key")
    for m, k in (("mart_driver_opportunity", "zone_hour_service_key"),
                 ("mart_congestion_proxy", "zone_hour_service_key"),
                 ("mart_profitability_scenario", "zone_day_service_key")):
        s.not_null(m, k).unique(m, k)
    for name in SINGULAR:
        s.singular(name, *SINGULAR[name][0])
    return s
# -----------------------------------------------------------------------------


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Union many same-schema frames as a balanced tree (each PySpark union
    re-analyses its inputs, so a left-deep chain costs O(n²) on the driver)."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


#: Row subsets of one model: (model, column, {model: which of its rows, None for all}).
Family = tuple[str, str, dict[str, "Column | None"]]


def _pair(check: int, key: Column | None, weights: list[Column], parent: bool = False) -> Column:
    return F.struct(F.lit(check).alias("check"), (key.cast("string") if key is not None else F.lit(None).cast("string")).alias("key"),
                    *(w.cast("long").alias(f"w{i}") for i, w in enumerate(weights)), F.lit(int(parent)).alias("parent"))


def _pairs_by_model(checks: list[Check], families: list[Family], width: int) -> dict[str, list[Column]]:
    """For every model that a check reads: the pairs that one of its rows gives (NULL for none).

    Weights count the rows; a family's pair has one weight for each member.
    """
    none = [F.lit(0)] * width
    one = [F.lit(1), *none[1:]]
    pairs: dict[str, list[Column]] = {}
    add = lambda model, when, pair: pairs.setdefault(model, []).append(F.when(when, pair))
    in_family = {(m, column): (k, base) for k, (base, column, members) in enumerate(families) for m in members}
    for k, (base, column, members) in enumerate(families):
        mine = [F.lit(1) if rows is None else F.when(rows, 1).otherwise(0) for rows in members.values()]
        add(base, F.col(column).isNotNull(), _pair(len(checks) + k, F.col(column), [*mine, *none[len(mine):]]))
    for i, c in enumerate(checks):
        value = F.col(c.column) if c.column else None
        if c.test == "not_null":
            add(c.model, value.isNull(), _pair(i, None, one))
        elif c.test == "unique" and (c.model, c.column) not in in_family:
            add(c.model, value.isNotNull(), _pair(i, value, one))
        elif c.test == "accepted_values":
            add(c.model, ~value.isin(list(c.values)), _pair(i, value, one))
        elif c.test == "relationships":
            add(c.model, value.isNotNull(), _pair(i, value, one))
            add(c.parent, F.col(c.parent_field).isNotNull(), _pair(i, F.col(c.parent_field), none, parent=True))
        elif c.test == "singular":
            inputs, failing = SINGULAR[c.name]
            if failing is not None:
                add(inputs[0], failing(), _pair(i, None, one))
            else:
                add(inputs[0], F.lit(True), _pair(i, F.lit("silver"), one))
                add(inputs[1], F.lit(True), _pair(i, F.lit("gold"), [F.col("trip_count"), *none[1:]]))
    return pairs


def run_checks(models: dict[str, DataFrame], suite: Suite | None = None, families: list[Family] | None = None) -> DataFrame:
    """One row per check: check_name, model, test, failures, status.

    ``families`` (optional): models that are row filters of a base model and keep
    a column unchanged; unique checks of that column are then answered from the
    base's pairs alone.
    """
    checks = (suite or default_suite()).checks
    wanted = {(c.model, c.column) for c in checks if c.test == "unique"}
    families = [(base, column, {m: rows for m, rows in members.items() if (m, column) in wanted}) for base, column, members in families or []]
    families = [f for f in families if f[2]]
    width = max([1, *(len(members) for _, _, members in families)])
    weights = [f"w{i}" for i in range(width)]
    parts = []
    for model, pairs in _pairs_by_model(checks, families, width).items():
        parts.append(models[model].select(F.inline(F.filter(F.array(*pairs), lambda p: p.isNotNull()))))
    by_pair = union_all(parts).groupBy("check", "key").agg(*(F.sum(w).alias(w) for w in weights), F.max("parent").alias("parent"))
    at = lambda key: F.max(F.when(F.col("key") == key, F.col("w0")))
    totals = by_pair.groupBy("check").agg(
        F.sum("w0").alias("rows"), F.count(F.lit(1)).alias("values"), F.sum(F.when(F.col("parent") == 0, F.col("w0")).otherwise(0)).alias("orphans"),
        *(F.count(F.when(F.col(w) > 1, 1)).alias(f"repeated_{w}") for w in weights),
        (at("gold").isNotNull() & (at("gold") != F.coalesce(at("silver"), F.lit(0)))).cast("long").alias("differ"))
    # which total answers which check
    measure = {"not_null": "rows", "unique": "repeated_w0", "accepted_values": "values", "relationships": "orphans", "singular": "rows"}
    asked = []
    for i, c in enumerate(checks):
        pair, column = i, "differ" if c.test == "singular" and SINGULAR[c.name][1] is None else measure[c.test]
        for k, (_, key, members) in enumerate(families):
            if c.test == "unique" and c.column == key and c.model in members:
                pair, column = len(checks) + k, f"repeated_w{list(members).index(c.model)}"
        asked.append(F.struct(F.lit(pair).alias("check"), F.lit(c.name).alias("check_name"), F.lit(c.model).alias("model"),
                              F.lit(c.test).alias("test"), F.lit(column).alias("measure")))
    spark = next(iter(models.values())).sparkSession
    listed = spark.range(1, numPartitions=1).select(F.inline(F.array(*asked)))
    measures = ["rows", "values", "orphans", "differ", *(f"repeated_{w}" for w in weights)]
    chosen = F.coalesce(*(F.when(F.col("measure") == m, F.col(m)) for m in measures), F.lit(0)).cast("long")
    return listed.join(totals, "check", "left").select(
        "check_name", "model", "test", chosen.alias("failures"), F.when(chosen == 0, "PASS").otherwise("FAIL").alias("status"))


# --- control-table constraints -----------------------------------------------------
#: Foreign keys of the control and ML tables: column, parent table, parent column.
FOREIGN_KEYS = {
    "pipeline_tasks": [("run_id", "pipeline_runs", "run_id")],
    "ingestion_files": [("first_run_id", "pipeline_runs", "run_id"), ("last_run_id", "pipeline_runs", "run_id")],
    "data_quality_results": [("run_id", "pipeline_runs", "run_id"), ("file_id", "ingestion_files", "file_id")],
    "model_metrics": [("model_run_id", "model_runs", "model_run_id")],
    "predictions": [("model_run_id", "model_runs", "model_run_id")],
}


def check_control_constraints(table: str, df: DataFrame, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Rows of a control/ML table that break its declared CHECK, UNIQUE and FOREIGN KEY constraints.

    Returns (table_name, constraint_name, failures) for every constraint of
    ``table``; foreign keys for the parent tables in ``parents``.
    """
    from farebox import schemas as S
    c = F.col
    rules: dict[str, list[tuple[str, object]]] = {
        "pipeline_runs": [
            ("mode", ~c("mode").isin(*S.RUN_MODES)),
            ("status", ~c("status").isin(*S.RUN_STATUSES)),
            ("end_after_start", c("end_date") < c("start_date")),
            ("orchestrator", ~c("orchestrator").isin(*S.ORCHESTRATORS)),
        ],
        "pipeline_tasks": [("status", ~c("status").isin(*S.TASK_STATUSES))],
        "ingestion_files": [
            ("source_kind", ~c("source_kind").isin(*S.SOURCE_KINDS)),
            ("service_type", ~c("service_type").isin(*S.SERVICES)),
            ("year", ~c("year").between(2009, 2100)),
            ("month", ~c("month").between(1, 12)),
            ("size_bytes", c("size_bytes") < 0),
            ("row_count", c("row_count") < 0),
            ("status", ~c("status").isin(*S.FILE_STATUSES)),
        ],
        "data_quality_results": [("status", ~c("status").isin(*S.QUALITY_STATUSES))],
        "model_metrics": [
            ("horizon_hours", ~c("horizon_hours").isin(*S.FORECAST_HORIZONS)),
            ("split", c("split") != "test"),
            ("sample_count", c("sample_count") <= 0),
            ("mae_not_null", c("mae").isNull()),
            ("rmse_not_null", c("rmse").isNull()),
        ],
        "predictions": [
            ("horizon_hours", ~c("horizon_hours").isin(*S.FORECAST_HORIZONS)),
            ("split", c("split") != "test"),
        ],
        "model_runs": [
            ("mode", ~c("mode").isin(*S.RUN_MODES)),
            ("status", ~c("status").isin(*S.RUN_STATUSES)),
        ],
    }
    unique_keys = {
        "ingestion_files": ("source_kind", "service_type", "year", "month", "filename"),
        "model_metrics": ("model_run_id", "model_name", "horizon_hours", "split"),
    }
    exprs = [F.count(F.when(cond, 1)).alias(name) for name, cond in rules[table]]
    agg = df.agg(*exprs)
    stack = ", ".join(f"'{n}', `{n}`" for n, _ in rules[table])
    out = agg.selectExpr(f"stack({len(rules[table])}, {stack}) AS (constraint_name, failures)")
    if table in unique_keys:
        keys = list(unique_keys[table])
        dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
               .agg(F.count(F.lit(1)).alias("failures"))
               .select(F.lit("unique_key").alias("constraint_name"), "failures"))
        out = out.unionByName(dup)
    for column, parent, field_ in FOREIGN_KEYS.get(table, []):
        if parent in (parents or {}) and column in df.columns:
            missing = check_relationships(df, column, parents[parent], field_).agg(F.count(F.lit(1)).alias("failures"))
            out = out.unionByName(missing.select(F.lit(f"foreign_key_{column}").alias("constraint_name"), "failures"))
    return out.select(F.lit(table).alias("table_name"), "constraint_name",
                      F.col("failures").cast("long").alias("failures"))
