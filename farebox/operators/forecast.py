"""Hourly demand forecasting per (service, zone): panel, densify, features,
temporal split, baseline and tree candidates, metrics and model selection.

Scale notes: every series is one (service, zone) pair — at most
4 services × 265 zones — and its length is bounded by the calendar span in
hours, not by trip volume, so the per-series windows never hold an unbounded
group.  Lags are window functions on the densified series (one shuffle on
(service, zone), reused by every window expression).
"""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.functions.columns import date_of_key, safe_div
from farebox.operators.tree_models import GROUP_ROWS, Boosting, ExtraTrees, fit_boosting
from farebox.schemas import FORECAST_HORIZONS, SERVICES

SERIES = ("service_type", "taxi_zone_key")
FEATURES = ("lag_origin", "lag_origin_1", "lag_origin_24", "rolling_mean_24",
            "hour_sin", "hour_cos", "weekday_sin", "weekday_cos", "service_code", "zone_code")
MODEL_ORDER = ("seasonal_naive", "extra_trees", "hist_gradient_boosting", "poisson_glm")


def service_code(col: str = "service_type"):
    """yellow=0, green=1, fhv=2, fhvhv=3 (catalogue order)."""
    expr = None
    for i, s in enumerate(SERVICES):
        expr = F.when(F.col(col) == s, float(i)) if expr is None else expr.when(F.col(col) == s, float(i))
    return expr


# --- J1: synthetic panel ---------------------------------------------------------------
def synthetic_hourly_demand(spark: SparkSession, days: int = 120, seed: int = 42,
                            zones: tuple[int, ...] = (161, 236, 237)) -> DataFrame:
    """Deterministic synthetic panel: Poisson demand around a daily double peak.

    intensity = max(0.1, (5 + 1.8·svc + 1.2·zone_ix) · weekly · trend · shape(hour));
    the Poisson draw is an inverse-CDF on a hash-derived uniform
    (``xxhash64(seed, service, zone, hour_index)``), so any partitioning gives
    the same panel.
    """
    hours = days * 24
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    combos = F.array(*[
        F.struct(F.lit(s).alias("service_type"), F.lit(i).alias("svc_ix"),
                 F.lit(z).alias("taxi_zone_key"), F.lit(j).alias("zone_ix"))
        for i, s in enumerate(SERVICES) for j, z in enumerate(zones)])
    g = (spark.range(0, hours).withColumnRenamed("id", "hour_index")
         .select("hour_index", F.explode(combos).alias("c"))
         .select("hour_index", "c.*")
         .withColumn("timestamp", F.timestamp_add("HOUR", F.col("hour_index"), start)))
    h = F.hour("timestamp").cast("double")
    weekly = F.when(F.weekday("timestamp") >= 5, F.lit(0.82)).otherwise(F.lit(1.0))
    trend = F.lit(1.0) + (F.col("hour_index") / F.lit(float(hours))) * F.lit(0.08)
    morning = F.exp(-((h - 8.0) * (h - 8.0)) / F.lit(8.0))
    evening = F.exp(-((h - 18.0) * (h - 18.0)) / F.lit(10.0))
    level = F.lit(5.0) + F.col("svc_ix") * F.lit(1.8) + F.col("zone_ix") * F.lit(1.2)
    intensity = F.greatest(F.lit(0.1), level * weekly * trend
                           * (F.lit(0.45) + F.lit(1.9) * morning + F.lit(1.6) * evening))
    u = (F.abs(F.xxhash64(F.lit(seed), "service_type", "taxi_zone_key", "hour_index")) % F.lit(1 << 52)
         ).cast("double") / F.lit(float(1 << 52))
    g = g.withColumn("lam", intensity).withColumn("u", u)
    # Poisson inverse CDF: walk the pmf p_k = p_{k-1}·lam/k until the cdf passes u.  The walk
    # ends 12 standard deviations above the mean, where less than 1e-15 of the mass is left
    # (a uniform of 52 bits can't reach it), so no intensity is cut off.
    lam = F.col("lam")
    last = F.ceil(lam + 12 * F.sqrt(lam) + 40).cast("int")
    init = F.struct(F.lit(0.0).alias("cdf"), F.exp(-lam).alias("p"), F.lit(-1).alias("res"))

    def step(acc, k):
        cdf = acc["cdf"] + acc["p"]
        return F.when(acc["res"] >= 0, acc).otherwise(F.struct(
            cdf.alias("cdf"), (acc["p"] * lam / (k + 1).cast("double")).alias("p"),
            F.when(cdf > F.col("u"), k).otherwise(F.lit(-1)).alias("res")))

    draw = F.aggregate(F.sequence(F.lit(0), last), init, step)["res"]
    return g.select("timestamp", "service_type", "taxi_zone_key",
                    F.when(draw < 0, last).otherwise(draw).cast("double").alias("demand"))


# --- J2: panel from the gold star --------------------------------------------------------
def hourly_panel(hourly: DataFrame) -> DataFrame:
    """(target_timestamp, service_type, taxi_zone_key, demand) from the hourly fact.

    The keys of the date and hour dimensions hold the timestamp, so the fact is
    read alone: joining the dimensions would only spell the keys out again.
    """
    return hourly.select(
        F.timestamp_add("HOUR", F.col("hour_key"), date_of_key("date_key").cast("timestamp_ntz"))
        .alias("target_timestamp"),
        F.col("service_type_key").alias("service_type"),
        "taxi_zone_key",
        F.col("trip_count").cast("double").alias("demand"),
    )


# --- J3: densify ---------------------------------------------------------------------------
def densify_hourly(panel: DataFrame, ts_col: str = "target_timestamp") -> DataFrame:
    """Every hour from each series' own first to last hour; missing hours → 0.0.

    The generated hour grid (NULL demand) is unioned with the observed points
    and hash-partitioned by (service, zone) once: that one shuffle serves the
    per-hour ``max`` (duplicate points collapse with max — a deterministic
    choice; the hourly fact's key is unique so it never fires on gold data)
    *and* the per-series windows of :func:`forecast_features`.  Each series is
    bounded by its calendar span in hours.
    """
    points = panel.select(*SERIES, ts_col, F.col("demand").cast("double").alias("demand"))
    bounds = points.groupBy(*SERIES).agg(F.min(ts_col).alias("first_ts"), F.max(ts_col).alias("last_ts"))
    grid = bounds.select(*SERIES, F.explode(F.sequence("first_ts", "last_ts", F.expr("INTERVAL 1 HOUR")))
                         .alias(ts_col), F.lit(None).cast("double").alias("demand"))
    both = points.unionByName(grid).repartition(*SERIES)
    return both.groupBy(*SERIES, ts_col).agg(F.max("demand").alias("demand")).select(
        *SERIES, ts_col, F.coalesce("demand", F.lit(0.0)).alias("demand"))


# --- J4: features ----------------------------------------------------------------------------
def forecast_features(dense: DataFrame, *horizons: int, ts_col: str = "target_timestamp") -> DataFrame:
    """Feature rows for targets at in-series index ≥ 48 (origin = target − h ≥ 24), for each horizon.

    All lags of all horizons come from one pass over the series; its rows are
    then repeated for each horizon.
    """
    if not horizons or any(h not in FORECAST_HORIZONS for h in horizons):
        raise ValueError("horizon_hours must be 1 or 24")
    w = Window.partitionBy(*SERIES).orderBy(ts_col)
    two_pi = 2 * math.pi
    hour = F.hour(ts_col).cast("double")
    wday = F.weekday(ts_col).cast("double")
    lags = sorted({h + back for h in horizons for back in (0, 1, 24)} | {24})
    seen = dense.select(
        *SERIES, ts_col, "demand",
        (F.row_number().over(w) - 1).alias("series_index"),
        *(F.lag("demand", k).over(w).alias(f"lag_{k}") for k in lags),
        *(F.avg("demand").over(w.rowsBetween(-(h + 23), -h)).alias(f"mean_{h}") for h in horizons),
    )
    by_horizon = F.inline(F.array(*(F.struct(
        F.lit(h).cast("int").alias("horizon_hours"), F.col(f"lag_{h}").alias("lag_origin"),
        F.col(f"lag_{h + 1}").alias("lag_origin_1"), F.col(f"lag_{h + 24}").alias("lag_origin_24"),
        F.col(f"mean_{h}").alias("rolling_mean_24")) for h in horizons)))
    return seen.filter(F.col("series_index") >= 48).select(*SERIES, ts_col, "demand", "lag_24", by_horizon).select(
        *SERIES, ts_col, "horizon_hours",
        "lag_origin", "lag_origin_1", "lag_origin_24", "rolling_mean_24",
        F.sin(F.lit(two_pi) * hour / F.lit(24.0)).alias("hour_sin"),
        F.cos(F.lit(two_pi) * hour / F.lit(24.0)).alias("hour_cos"),
        F.sin(F.lit(two_pi) * wday / F.lit(7.0)).alias("weekday_sin"),
        F.cos(F.lit(two_pi) * wday / F.lit(7.0)).alias("weekday_cos"),
        service_code().alias("service_code"),
        F.col("taxi_zone_key").cast("double").alias("zone_code"),
        F.col("demand").alias("target"),
        F.col("lag_24").alias("baseline"),
    )


# --- J5: temporal split ---------------------------------------------------------------------
def target_hours(panel: DataFrame, ts_col: str = "target_timestamp") -> DataFrame:
    """Distinct target hours of the features of a (dense or sparse) panel.

    A series is dense from its first to its last hour and its targets start at
    index 48, so the hours follow from the bounds of each series: one partial
    aggregation, no windows.
    """
    bounds = panel.groupBy(*SERIES).agg(F.min(ts_col).alias("a"), F.max(ts_col).alias("b"))
    first = F.timestamp_add("HOUR", F.lit(48), F.col("a"))
    return (bounds.select(first.alias("a"), "b").filter(F.col("a") <= F.col("b"))
            .select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("ts")).distinct())


def temporal_cutoff(panel: DataFrame, test_fraction: float = 0.2, min_hours: int = 720,
                    ts_col: str = "target_timestamp"):
    """Global cutoff = sorted distinct target hours[int(n · (1 − test_fraction))].

    Exact and distributed: distinct hours are counted per day (the only rows
    that reach the driver are one count per calendar day), the cutoff day and
    position follow from a running total, and only that day's ≤ 24 hours are
    read back.  Raises when fewer than ``min_hours`` hours exist.
    """
    hours = target_hours(panel, ts_col)
    per_day = sorted((r["d"], r["c"]) for r in
                     hours.groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("c")).collect())
    n = sum(c for _, c in per_day)
    if n < min_hours:
        raise ValueError(f"need at least {min_hours} distinct hourly targets for a temporal split, got {n}")
    k = int(n * (1.0 - test_fraction))          # 0-based position of the cutoff hour
    before = 0
    for day, c in per_day:
        if before + c > k:
            break
        before += c
    day_hours = sorted(r["ts"] for r in
                       hours.filter(F.to_date("ts") == F.lit(day.isoformat()).cast("date")).collect())
    return day_hours[k - before]


def temporal_split(features: DataFrame, cutoff, ts_col: str = "target_timestamp") -> DataFrame:
    """Adds ``split`` ('train' before the cutoff, 'test' from it) and ``cutoff``.

    Both horizons share their target hours (in-series index ≥ 48), so a cutoff
    computed for one can be passed in for the other.
    """
    c = F.lit(cutoff.isoformat(sep=" ")).cast("timestamp_ntz")   # string → NTZ: no time-zone shift
    return features.withColumn("split", F.when(F.col(ts_col) < c, "train").otherwise("test")) \
        .withColumn("cutoff", c)


# --- J6-J7: candidates ------------------------------------------------------------------------
def seasonal_naive(split_features: DataFrame) -> DataFrame:
    """Prediction = demand 24 hours before the target."""
    return _prediction_rows(split_features.filter(F.col("split") == "test"), "seasonal_naive",
                            F.col("baseline"))


def _prediction_rows(df: DataFrame, model: str, pred) -> DataFrame:
    return df.select(
        F.lit(model).alias("model_name"),
        F.col("horizon_hours").cast("short").alias("horizon_hours"),
        "target_timestamp", "service_type", "taxi_zone_key",
        F.col("target").alias("actual_demand"),
        pred.cast("double").alias("predicted_demand"),
        F.lit("test").alias("split"),
    )


def train_candidates(split_features: DataFrame, folder: str, num_trees: int = 120, max_iter: int = 120,
                     seed: int = 42, extra: tuple[str, ...] = (), group_rows: int = GROUP_ROWS
                     ) -> tuple[DataFrame, dict[str, ExtraTrees], dict[tuple[str, int], object]]:
    """Fit extra-trees and histogram boosting on the train rows of every horizon.

    ``split_features``: stored rows of one or more horizons.  ``folder``: shared,
    for the forest's branches.  ``extra=("poisson",)`` adds a Poisson GLM with log
    link (the structured count baseline named in the project plan).  Returns the
    test predictions of all candidates, clipped at 0, incl. the seasonal baseline;
    the forest of all horizons; the other fitted models by name and horizon.
    """
    train = split_features.filter(F.col("split") == "train")
    test = split_features.filter(F.col("split") == "test")
    of = lambda rows, h: rows.filter(F.col("horizon_hours") == h)

    # all horizons together; forest and boosting are independent, so they run as concurrent jobs
    with ThreadPoolExecutor(max_workers=2) as pool:
        boosting = pool.submit(fit_boosting, train, FEATURES, "target", "horizon_hours", f"{folder}/boosting",
                               Boosting(iterations=max_iter, rate=0.08, leaves=31, l2=0.1, seed=seed), group_rows)
        forest = ExtraTrees(FEATURES, "target", "horizon_hours", f"{folder}/forest", trees=num_trees, min_leaf=2, seed=seed,
                            group_rows=group_rows).fit(train)
        fitted = {("hist_gradient_boosting", h): model for h, model in sorted(boosting.result().items())}
    horizons = [h for _, h in fitted]
    predicted = [("extra_trees", forest.predict(test))]
    predicted += [(name, model.predict(of(test, h))) for (name, h), model in fitted.items()]
    if "poisson" in extra:
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import GeneralizedLinearRegression

        glm = GeneralizedLinearRegression(labelCol="target", featuresCol="features", family="poisson", link="log",
                                          maxIter=50, regParam=1e-4)
        assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform
        for h in horizons:
            fitted["poisson_glm", h] = glm.fit(assemble(of(train, h)))
            predicted.append(("poisson_glm", fitted["poisson_glm", h].transform(assemble(of(test, h)))))
    out = seasonal_naive(split_features)
    for name, rows in predicted:
        out = out.unionByName(_prediction_rows(rows, name, F.greatest(F.lit(0.0), F.col("prediction"))))
    return out, {"extra_trees": forest}, fitted


# --- J8-J9: metrics and selection ---------------------------------------------------------
def forecast_metrics(predictions: DataFrame) -> DataFrame:
    """MAE, RMSE, WAPE, R² and sample_count per (model_name, horizon_hours).

    One pass: the total sum of squares is n times the population variance, which
    Spark merges without cancellation.  A constant target gives R² 1.0 when SSE = 0
    else 0.0; n ≤ 1 gives NULL.  WAPE is NULL when Σ|actual| = 0.
    """
    keys = ["model_name", "horizon_hours"]
    err = F.col("actual_demand") - F.col("predicted_demand")
    agg = predictions.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("sample_count"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.sum(F.abs(err)).alias("sum_abs_err"),
        F.sum(F.abs("actual_demand")).alias("sum_abs_actual"),
        F.sum(err * err).alias("sse"),
        (F.var_pop("actual_demand") * F.count(F.lit(1))).alias("sst"),
    )
    r2 = (F.when(F.col("sample_count") <= 1, F.lit(None).cast("double"))
          .when(F.col("sst") == 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("sse") / F.col("sst")))
    return agg.select(*keys, F.lit("test").alias("split"), "mae", "rmse",
                      safe_div("sum_abs_err", "sum_abs_actual").alias("wape"),
                      r2.alias("r2"), "sample_count")


def select_model(metrics: DataFrame) -> DataFrame:
    """Adds ``is_selected``: lowest MAE per horizon (NULL last); ties follow the
    candidate order seasonal_naive, extra_trees, hist_gradient_boosting."""
    rank = F.lit(len(MODEL_ORDER))
    for i, m in reversed(list(enumerate(MODEL_ORDER))):
        rank = F.when(F.col("model_name") == m, F.lit(i)).otherwise(rank)
    w = Window.partitionBy("horizon_hours").orderBy(F.col("mae").asc_nulls_last(), rank)
    return metrics.withColumn("is_selected", F.row_number().over(w) == 1)


def error_breakdown(predictions: DataFrame, by: str) -> DataFrame:
    """Error by zone / hour / service (T6): MAE, WAPE, MAPE over non-zero actuals."""
    key = {"zone": F.col("taxi_zone_key"), "hour": F.hour("target_timestamp").cast("int"),
           "service": F.col("service_type")}[by]
    err = F.abs(F.col("actual_demand") - F.col("predicted_demand"))
    return predictions.groupBy("model_name", "horizon_hours", key.alias(by)).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.avg(err).alias("mae"),
        safe_div(F.sum(err), F.sum(F.abs("actual_demand"))).alias("wape"),
        F.avg(F.when(F.col("actual_demand") != 0, err / F.abs("actual_demand"))).alias("mape"),
    )
