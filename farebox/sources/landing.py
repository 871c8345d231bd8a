"""Landing table: idempotent append, manifest upsert, zone seed, sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox.schemas import LANDING_KEY, LANDING_SCHEMA, MANIFEST_KEY, ZONE_LOOKUP_SCHEMA


def dedupe_on_key(df: DataFrame, key: tuple[str, ...] = LANDING_KEY) -> DataFrame:
    """One row per key, deterministically the smallest row (loaded_at first).

    A grouped ``min(struct)`` is partially aggregated map-side, so even a key
    duplicated across a third of the input ships one row per map task.
    """
    rest = [c for c in df.columns if c not in key]
    order = (["loaded_at"] if "loaded_at" in rest else []) + [c for c in rest if c != "loaded_at"]
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("r"))
    return first.select(*key, *[F.col(f"r.{c}").alias(c) for c in rest]).select(*df.columns)


def landing_rows_to_insert(new: DataFrame, existing: DataFrame) -> DataFrame:
    """``INSERT … ON CONFLICT (key) DO NOTHING``: new rows whose key is not yet landed.

    Only the landed rows of the files present in ``new`` can conflict, so the
    existing side is first restricted to those (source_kind, source_file_id)
    pairs; with landing partitioned by file that restriction prunes partitions.
    """
    files = new.select("source_kind", "source_file_id").distinct()
    relevant = existing.select(*LANDING_KEY).join(files, ["source_kind", "source_file_id"], "left_semi")
    # distinct keys: duplicated keys in a damaged landing table collapse map-side,
    # and the aggregation's key partitioning is the one the anti-join needs
    return dedupe_on_key(new).join(relevant.distinct(), list(LANDING_KEY), "left_anti")


def landed(spark: SparkSession, landing_path: str) -> DataFrame:
    """The landing table, empty before the first load.  Only a missing path counts
    as a first load: any other read error is raised, else it would land rows twice."""
    try:
        return spark.read.schema(LANDING_SCHEMA).parquet(landing_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LANDING_SCHEMA)


def append_landing(new: DataFrame, landing_path: str) -> int:
    """Append new landing rows to a Parquet landing table (partitioned by file).

    Returns the number of rows inserted; a rerun over the same input inserts 0.
    """
    spark = new.sparkSession
    rows = landing_rows_to_insert(new, landed(spark, landing_path))
    spark.sparkContext.setJobDescription("append landing")
    from farebox.session import checkpoint_dir
    checkpoint_dir(spark)
    rows = rows.checkpoint(eager=True)      # fix the batch before writing next to what it read
    n = rows.count()
    if n:
        rows.write.mode("append").partitionBy("source_kind", "source_file_id").parquet(landing_path)
    return n


def upsert_manifest(new: DataFrame, existing: DataFrame) -> DataFrame:
    """``ON CONFLICT (source_kind, service_type, year, month, filename) DO UPDATE``.

    Matched files take the new size, digest, status, last run and update time
    (now, unless given) but keep ``file_id``, ``first_run_id``, URL and row count; unseen files get fresh ids after the
    current maximum (ordered by key, so ids are deterministic).  The manifest
    has one row per source file (hundreds to thousands), so the numbering
    window over new files is small by construction.
    """
    key = list(MANIFEST_KEY)
    upd = ["size_bytes", "sha256", "status", "last_run_id"]
    once = ["source_url", "row_count"]
    n = new.select(*key, *upd, *once, "first_run_id", "updated_at", F.lit(True).alias("_in_new")).alias("n")
    e = existing.select("file_id", *key, *upd, *once, "first_run_id", "updated_at").alias("e")
    j = e.join(n, key, "full_outer")
    stamp = dict(new.dtypes)["updated_at"]
    current_max = existing.agg(F.coalesce(F.max("file_id"), F.lit(0)).alias("m")).first()["m"]
    fresh = F.col("e.file_id").isNull()
    numbered = j.withColumn("_rn", F.row_number().over(Window.partitionBy(fresh).orderBy(*key)))
    in_new = F.col("n._in_new").isNotNull()
    out = numbered.select(
        F.when(fresh, F.lit(current_max) + F.col("_rn")).otherwise(F.col("e.file_id")).cast("long").alias("file_id"),
        *key,
        *[F.when(in_new, F.col(f"n.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in upd],
        *[F.when(fresh, F.col(f"n.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in once],
        F.coalesce(F.col("e.first_run_id"), F.col("n.first_run_id")).alias("first_run_id"),
        F.when(in_new, F.coalesce(F.col("n.updated_at"), F.current_timestamp().cast(stamp)))
        .otherwise(F.col("e.updated_at")).alias("updated_at"),
    )
    return out.select("file_id", *key, "source_url", "size_bytes", "sha256", "row_count", "status",
                      "first_run_id", "last_run_id", "updated_at")


def load_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Zone seed CSV with typed ``location_id``; the literal 'N/A' stays a string."""
    return spark.read.schema(ZONE_LOOKUP_SCHEMA).option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None) -> None:
    """Bulk sink for control / ML / model tables (Parquet)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append") -> None:
    """Optional relational sink via Spark's JDBC writer (driver jar must be on the classpath)."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)
