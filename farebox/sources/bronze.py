"""Bronze files: JSON → Parquet, partitioned writes, digests, validation and the
projection of each service's physical schema onto the landing contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import LANDING_SCHEMA, SERVICES

# --- fixed values: accepted physical column names per landing column ----------
# (public trip-record data dictionaries; matched case-insensitively)
COLUMN_ALIASES = {
    "yellow": {
        "pickup_datetime": ["tpep_pickup_datetime", "pickup_datetime"],
        "dropoff_datetime": ["tpep_dropoff_datetime", "dropoff_datetime"],
        "pickup_location_id": ["PULocationID", "pickup_location_id"],
        "dropoff_location_id": ["DOLocationID", "dropoff_location_id"],
        "trip_distance": ["trip_distance"],
        "total_amount": ["total_amount"],
    },
    "green": {
        "pickup_datetime": ["lpep_pickup_datetime", "pickup_datetime"],
        "dropoff_datetime": ["lpep_dropoff_datetime", "dropoff_datetime"],
        "pickup_location_id": ["PULocationID", "pickup_location_id"],
        "dropoff_location_id": ["DOLocationID", "dropoff_location_id"],
        "trip_distance": ["trip_distance"],
        "total_amount": ["total_amount"],
    },
    "fhv": {
        "pickup_datetime": ["pickup_datetime"],
        "dropoff_datetime": ["dropOff_datetime", "dropoff_datetime"],
        "pickup_location_id": ["PUlocationID", "pickup_location_id"],
        "dropoff_location_id": ["DOlocationID", "dropoff_location_id"],
        "dispatching_base_num": ["dispatching_base_num"],
    },
    "fhvhv": {
        "pickup_datetime": ["pickup_datetime"],
        "dropoff_datetime": ["dropoff_datetime"],
        "pickup_location_id": ["PULocationID", "pickup_location_id"],
        "dropoff_location_id": ["DOLocationID", "dropoff_location_id"],
        "trip_distance": ["trip_miles", "trip_distance"],
        "total_amount": ["total_amount"],
        "dispatching_base_num": ["dispatching_base_num"],
        "hvfhs_license_num": ["hvfhs_license_num"],
    },
}
REQUIRED = ("pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id")
# -----------------------------------------------------------------------------


def resolve_column(df: DataFrame, candidates: list[str]) -> str | None:
    """First physical column matching a candidate name, case-insensitively."""
    lower = {c.lower(): c for c in df.columns}
    for cand in candidates:
        if cand.lower() in lower:
            return lower[cand.lower()]
    return None


def json_to_parquet(spark: SparkSession, json_path: str, out_path: str, schema=None) -> int:
    """Read JSON records and write them as snappy Parquet; zero records → no output.

    Returns the number of records written.  (The emptiness check reads at most
    one row.)
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.json(json_path)
    if df.limit(1).count() == 0:
        return 0
    df.write.mode("errorifexists").option("compression", "snappy").parquet(out_path)
    return spark.read.parquet(out_path).count()


def bronze_path(root: str, service: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/{service}/year={year:04d}/month={month:02d}"


def write_bronze(df: DataFrame, root: str, service: str, year: int, month: int,
                 on_conflict: str = "fail") -> str:
    """Write one service-month under ``service/year=YYYY/month=MM``.

    on_conflict: 'ignore' (demo reruns keep the first copy), 'fail' (real files
    are immutable) or 'replace' (quarantine copies).  Spark save modes act per
    directory, which here is exactly one Bronze file's partition.
    """
    mode = {"ignore": "ignore", "fail": "errorifexists", "replace": "overwrite"}[on_conflict]
    path = bronze_path(root, service, year, month)
    df.write.mode(mode).option("compression", "snappy").parquet(path)
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Read Bronze Parquet with file name and 1-based row number per file."""
    df = spark.read.parquet(path)
    return df.select("*", F.col("_metadata.file_name").alias("_file_name"),
                     (F.col("_metadata.row_index") + 1).alias("_row_number"))


def _stream_sha256(batches):
    """mapInPandas body: SHA-256 of each listed file, read in 8 MiB chunks
    (bounded memory whatever the file size; any pyarrow filesystem URI)."""
    import hashlib

    import pandas as pd
    from pyarrow import fs as pafs

    for pdf in batches:
        digests = []
        for path in pdf["path"]:
            filesystem, inner = pafs.FileSystem.from_uri(path)
            h = hashlib.sha256()
            with filesystem.open_input_stream(inner) as stream:
                while True:
                    chunk = stream.read(8 << 20)
                    if not chunk:
                        break
                    h.update(chunk)
            digests.append(h.hexdigest())
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "sha256": digests})


def file_digests(spark: SparkSession, path_glob: str) -> DataFrame:
    """SHA-256, size and status per file (FAILED when the file is empty).

    Files are listed with Spark's binary-file source with the ``content``
    column pruned (only path and length are read), then each file is hashed as
    a stream on an executor, so a multi-GB file never sits in one row.
    """
    listed = spark.read.format("binaryFile").load(path_glob).select("path", "length")
    hashed = listed.mapInPandas(_stream_sha256, "path string, length long, sha256 string")
    return hashed.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size_bytes"),
        "sha256",
        F.when(F.col("length") == 0, "FAILED").otherwise("DOWNLOADED").alias("status"),
    )


def validate_bronze(df: DataFrame, service: str, path_service: str, path_year: int,
                    path_month: int, file_name: str | None = None) -> DataFrame:
    """PASS/FAIL rows for one Bronze file: readable content, ≥1 row and column,
    required columns present under an accepted alias, and path identity.

    Data-dependent checks run as one aggregation (row count and pickup-month
    agreement); schema checks are metadata only.
    """
    from farebox.sources.inventory import parse_file_identity

    spark = df.sparkSession
    aliases = COLUMN_ALIASES.get(service, {})
    checks: list[tuple[str, bool, str, str]] = []
    checks.append(("has_columns", len(df.columns) >= 1, str(len(df.columns)), ">=1"))
    for col in REQUIRED:
        found = resolve_column(df, aliases.get(col, [col]))
        checks.append((f"has_{col}", found is not None, found or "missing", "|".join(aliases.get(col, [col]))))
    checks.append(("path_service_matches", service == path_service, path_service, service))
    static = spark.range(1, numPartitions=1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.lit(bool(ok)).alias("passed"),
                 F.lit(obs).cast("string").alias("observed_value"), F.lit(exp).cast("string").alias("expected_value"))
        for n, ok, obs, exp in checks])))
    pick = resolve_column(df, aliases.get("pickup_datetime", ["pickup_datetime"]))
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count(F.when((F.year(pick) == path_year) & (F.month(pick) == path_month), 1))
         if pick else F.lit(0)).alias("in_month"),
    )
    dynamic = stats.select(F.explode(F.array(
        F.struct(F.lit("has_rows").alias("check_name"), (F.col("n") >= 1).alias("passed"),
                 F.col("n").cast("string").alias("observed_value"), F.lit(">=1").alias("expected_value")),
        F.struct(F.lit("pickup_month_matches_path").alias("check_name"),
                 (F.col("in_month") * 2 >= F.col("n")).alias("passed"),
                 F.format_string("%d/%d", F.col("in_month"), F.col("n")).alias("observed_value"),
                 F.lit(f"{path_year:04d}-{path_month:02d}").alias("expected_value")),
    )).alias("c")).select("c.*")
    out = static.unionByName(dynamic)
    if file_name is not None:
        ident = spark.range(1, numPartitions=1).select(parse_file_identity(F.lit(file_name)).alias("i"))
        name_ok = ident.select(
            F.lit("file_name_matches_path").alias("check_name"),
            ((F.col("i.service_type") == path_service) & (F.col("i.year") == path_year)
             & (F.col("i.month") == path_month)).alias("passed"),
            F.lit(file_name).alias("observed_value"),
            F.lit(f"{path_service}_tripdata_{path_year:04d}-{path_month:02d}").alias("expected_value"))
        out = out.unionByName(name_ok)
    return out.select("check_name", F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("status"),
                      "observed_value", "expected_value")


def normalize_to_landing(df: DataFrame, service: str, source_kind: str, file_id: int | Column,
                         filename: str | Column, row_number: str = "_row_number",
                         loaded_at: Column | None = None) -> DataFrame:
    """Project a service's physical columns onto the 14 landing columns.

    Absent fields become NULL (never 0).  ``row_number`` must already hold the
    1-based row position inside the source file (see :func:`read_bronze`).
    """
    if service not in SERVICES:
        raise ValueError(f"unknown service {service!r}")
    aliases = COLUMN_ALIASES[service]

    def pick(col: str, dtype) -> Column:
        found = resolve_column(df, aliases.get(col, []))
        return (F.col(found).cast(dtype) if found else F.lit(None).cast(dtype)).alias(col)

    types = {f.name: f.dataType for f in LANDING_SCHEMA.fields}
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        F.lit(source_kind).alias("source_kind"),
        lit(file_id).cast("long").alias("source_file_id"),
        lit(filename).cast("string").alias("source_filename"),
        F.col(row_number).cast("long").alias("source_row_number"),
        F.lit(service).alias("service_type"),
        pick("pickup_datetime", types["pickup_datetime"]),
        pick("dropoff_datetime", types["dropoff_datetime"]),
        pick("pickup_location_id", types["pickup_location_id"]),
        pick("dropoff_location_id", types["dropoff_location_id"]),
        pick("trip_distance", types["trip_distance"]),
        pick("total_amount", types["total_amount"]),
        pick("dispatching_base_num", types["dispatching_base_num"]),
        pick("hvfhs_license_num", types["hvfhs_license_num"]),
        (loaded_at if loaded_at is not None else F.current_timestamp()).cast("timestamp").alias("loaded_at"),
    )


def raw_frame(landing: DataFrame, service: str) -> DataFrame:
    """Inverse of :func:`normalize_to_landing` for one service: landing rows of
    that service renamed to the first physical alias (used to exercise the
    projection on real table data)."""
    aliases = COLUMN_ALIASES[service]
    cols = [F.col(c).alias(names[0]) for c, names in aliases.items()]
    keep = [F.col(c) for c in ("source_kind", "source_file_id", "source_filename",
                                "source_row_number", "loaded_at")]
    return landing.filter(F.col("service_type") == service).select(*keep, *cols)
