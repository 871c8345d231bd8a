"""Monthly file inventory, pending downloads, coverage and file-name identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import DEFAULT_BASE_URL, MANIFEST_KEY

FILE_NAME_PATTERN = r"(yellow|green|fhvhv|hvfhv|fhv)_tripdata_([0-9]{4})-([0-9]{2})"
DONE_STATUSES = ("VALIDATED", "PROCESSED")


def file_inventory(requests: DataFrame, base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Expand (start_date, end_date, services) request rows into one row per
    (month, service): months are inclusive and truncated to the month; service
    names are split on ',' with all whitespace removed.  A request whose start
    is after its end yields no rows.
    """
    r = requests.select(
        F.trunc(F.to_date("start_date"), "MM").alias("s"),
        F.trunc(F.to_date("end_date"), "MM").alias("e"),
        F.split(F.col("services"), ",").alias("svcs"),
    ).filter(F.col("s") <= F.col("e"))
    months = r.select(F.explode(F.sequence("s", "e", F.expr("INTERVAL 1 MONTH"))).alias("m"), "svcs")
    rows = months.select("m", F.posexplode("svcs").alias("pos", "svc"))
    svc = F.regexp_replace("svc", r"\s", "")
    filename = F.format_string("%s_tripdata_%04d-%02d.parquet", svc, F.year("m"), F.month("m"))
    return rows.select(
        F.lit("tlc").alias("source_kind"),
        svc.alias("service_type"),
        F.year("m").alias("year"),
        F.month("m").alias("month"),
        filename.alias("filename"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), filename).alias("source_url"),
    )


def trip_file_inventory(spark: SparkSession, start_date: str, end_date: str, services: str,
                        base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    req = spark.createDataFrame([(start_date, end_date, services)], "start_date string, end_date string, services string")
    return file_inventory(req, base_url)


def pending_files(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Inventory rows not yet VALIDATED/PROCESSED in the manifest (to download)."""
    done = manifest.filter(F.col("status").isin(*DONE_STATUSES)).select(*MANIFEST_KEY)
    inv = inventory.withColumn("year", F.col("year").cast("short")).withColumn("month", F.col("month").cast("short"))
    return inv.join(done, list(MANIFEST_KEY), "left_anti")


def inventory_actions(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Every inventory file with its action: SKIPPED when the manifest already has
    it VALIDATED/PROCESSED, else DOWNLOAD.  The manifest side is reduced to its
    done keys (one row per file) before the left join."""
    done = (manifest.filter(F.col("status").isin(*DONE_STATUSES)).select(*MANIFEST_KEY)
            .distinct().withColumn("_done", F.lit(True)))
    inv = inventory.withColumn("year", F.col("year").cast("short")).withColumn("month", F.col("month").cast("short"))
    return inv.join(done, list(MANIFEST_KEY), "left").select(
        *inv.columns, F.when(F.col("_done"), "SKIPPED").otherwise("DOWNLOAD").alias("action"))


def bronze_coverage(manifest: DataFrame, source_kind: str = "tlc") -> DataFrame:
    """Per service: first/last month, file count and bytes of usable files."""
    m = manifest.filter((F.col("source_kind") == source_kind) & F.col("status").isin(*DONE_STATUSES))
    month = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
    return m.groupBy("service_type").agg(
        F.min(month).alias("first_month"),
        F.max(month).alias("last_month"),
        F.count(F.lit(1)).alias("files"),
        F.sum("size_bytes").cast("long").alias("bytes"),
    ).orderBy("service_type")


def parse_file_identity(name: Column | str) -> Column:
    """struct(service_type, year, month) parsed from a trip file name; the
    ``hvfhv`` spelling is treated as ``fhvhv``.  Fields are NULL on no match."""
    n = F.col(name) if isinstance(name, str) else name
    svc = F.regexp_extract(n, FILE_NAME_PATTERN, 1)
    year = F.regexp_extract(n, FILE_NAME_PATTERN, 2)
    month = F.regexp_extract(n, FILE_NAME_PATTERN, 3)
    ok = svc != ""
    return F.struct(
        F.when(ok, F.when(svc == "hvfhv", "fhvhv").otherwise(svc)).alias("service_type"),
        F.when(ok, year.cast("int")).alias("year"),
        F.when(ok, month.cast("int")).alias("month"),
    )
