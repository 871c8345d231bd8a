"""Bronze files of many shapes: inspection, validation and projection file by file.

Files of one service differ over the years in column names and types.  So every
file's footer is read by a task (an unreadable file gives a row that says so),
files are grouped by physical schema, and each group is read and projected onto
the landing contract on its own.  What reaches the driver is one row a schema
with its files' names.

A file's identity is its content: ``file_id`` comes from the SHA-256 digest (or
from the manifest, where it knows the digest), so a file that is delivered again
under another name, or a batch that is repeated after a crash, brings keys that
have landed already.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import LANDING_SCHEMA, SERVICES
from farebox.sources.bronze import COLUMN_ALIASES, REQUIRED
from farebox.sources.inventory import parse_file_identity

INSPECTED = ("file_path string, path string, length long, sha256 string, readable boolean, error string, num_rows long, "
             "columns array<struct<name: string, type: string>>")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """file_path, path and length of all Parquet files below ``root`` (contents are not read).

    Spark's sources hand out no rows for files without a byte, so names come from
    the listing itself (one a file, on the driver, as for any read).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root))
    names = spark.createDataFrame([(_same_form(n),) for n in files.inputFiles()], "file_path string")
    filled = files.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file_path"), "path", "length")
    return names.join(filled, "file_path", "left").select("file_path", F.coalesce("path", "file_path").alias("path"), F.coalesce("length", F.lit(0)).alias("length"))


def _same_form(path: str) -> str:
    return re.sub("^file:/+", "file:/", path)


def _inspect(batches: Iterator) -> Iterator:
    """Digest (in 8 MiB steps) and footer of each listed file; a file that can't be read is reported, not raised."""
    import hashlib

    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyarrow import fs as pafs

    kind = pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("sha256", "readable", "error", "num_rows", "columns")}
        for path in batch.column(1).to_pylist():
            row: dict[str, object] = {"readable": False}
            try:
                filesystem, inner = pafs.FileSystem.from_uri(path)
                digest = hashlib.sha256()
                with filesystem.open_input_stream(inner) as stream:
                    while chunk := stream.read(8 << 20):
                        digest.update(chunk)
                row["sha256"] = digest.hexdigest()
                with filesystem.open_input_file(inner) as file:
                    footer = pq.ParquetFile(file)
                    schema = footer.schema_arrow
                    row |= {"readable": True, "num_rows": footer.metadata.num_rows,
                            "columns": [{"name": f.name, "type": str(f.type)} for f in schema]}
            except (OSError, ValueError, pa.ArrowException) as failure:
                row["error"] = str(failure)[:500]
            for key, values in out.items():
                values.append(row.get(key))
        types = {"sha256": pa.string(), "readable": pa.bool_(), "error": pa.string(), "num_rows": pa.int64(), "columns": kind}
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(v, types[k]) for k, v in out.items())], [*batch.schema.names, *out])


def inspect_files(files: DataFrame) -> DataFrame:
    """Listed files with digest, readability, rows, physical columns, and identity.

    ``service_type``, ``year``, ``month`` are what the folders say
    (``service/year=YYYY/month=MM``), ``named`` what the file name says, if anything.
    """
    seen = files.select("file_path", "path", "length").mapInArrow(_inspect, INSPECTED)
    name = F.element_at(F.split("path", "/"), -1)
    folder = lambda pattern: F.nullif(F.regexp_extract("path", pattern, 1), F.lit(""))
    service = folder(r"/([a-z]+)/year=\d{4}/month=\d{1,2}/")
    return seen.select(
        "*", name.alias("file_name"), service.alias("service_type"),
        folder(r"/year=(\d{4})/").cast("int").alias("year"), folder(r"/month=(\d{1,2})/").cast("int").alias("month"),
        parse_file_identity(name).alias("named"),
        F.conv(F.substring("sha256", 1, 13), 16, 10).cast("long").alias("file_id"),
        F.md5(F.to_json("columns")).alias("schema_key"))


def _resolved(columns: Column, service: Column, landing_column: str) -> Column:
    """The physical column that stands for a landing column: the first accepted alias that the file has."""
    accepted = {s: [a.lower() for a in COLUMN_ALIASES[s].get(landing_column, [])] for s in SERVICES}
    aliases = F.array().cast("array<string>")
    for s in SERVICES:
        aliases = F.when(service == s, F.array(*(F.lit(a) for a in accepted[s])).cast("array<string>")).otherwise(aliases)
    have = F.transform(columns, lambda c: F.lower(c["name"]))
    alias = F.try_element_at(F.filter(aliases, lambda a: F.array_contains(have, a)), F.lit(1))
    return F.try_element_at(F.filter(columns, lambda c: F.lower(c["name"]) == alias), F.lit(1))["name"]


def validate_files(inspected: DataFrame, pickup_months: DataFrame | None = None) -> DataFrame:
    """PASS / FAIL rows of every file: readable, rows, columns, required columns, identity.

    ``pickup_months`` (of :func:`pickup_months`) adds, for readable files that
    have them, whether most pickups lie in the month of the folder.
    """
    columns = F.coalesce("columns", F.array().cast("array<struct<name: string, type: string>>"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit("missing"))
    checks = [
        ("readable", F.col("readable"), F.when(F.col("readable"), "readable").otherwise("unreadable"), F.lit("readable")),
        ("has_rows", F.col("num_rows") >= 1, text(F.col("num_rows")), F.lit(">=1")),
        ("has_columns", F.size(columns) >= 1, F.size(columns).cast("string"), F.lit(">=1")),
    ]
    for c in REQUIRED:
        found = _resolved(columns, F.col("service_type"), c)
        checks.append((f"has_{c}", found.isNotNull(), text(found), F.lit(c)))
    path = F.concat_ws("-", "service_type", "year", "month")
    named = F.concat_ws("-", "named.service_type", "named.year", "named.month")
    checks.append(("path_names_service_and_month", F.col("service_type").isin(*SERVICES) & F.col("year").isNotNull() & F.col("month").between(1, 12),
                   path, F.lit("service-year-month")))
    checks.append(("file_name_matches_path", (F.col("named.service_type").isNull()) | (named == path), F.coalesce(F.nullif(named, F.lit("")), F.lit("no identity")), path))
    rows = F.inline(F.array(*(F.struct(F.lit(n).alias("check_name"), F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
                                       seen.alias("observed_value"), want.alias("expected_value")) for n, ok, seen, want in checks)))
    out = inspected.select("file_path", "file_name", rows)
    if pickup_months is None:
        return out
    agree = inspected.filter("readable").join(pickup_months, "file_path").select(
        "file_path", "file_name", F.lit("pickup_month_matches_path").alias("check_name"),
        F.when((F.col("n") == F.col("num_rows")) & (2 * F.col("in_month") >= F.col("n")), "PASS").otherwise("FAIL").alias("status"),
        F.format_string("%d/%d", "in_month", "n").alias("observed_value"), F.format_string("%04d-%02d", "year", "month").alias("expected_value"))
    return out.unionByName(agree)


def valid_files(inspected: DataFrame) -> DataFrame:
    """The files that pass every check of :func:`validate_files` but the one on their rows."""
    failed = validate_files(inspected).filter("status = 'FAIL'").select("file_path").distinct()
    return inspected.join(failed, "file_path", "left_anti")


def _groups(files: DataFrame) -> list:
    """service_type, schema_key and the paths of each group of files that one read can take (one row a physical schema)."""
    return files.groupBy("service_type", "schema_key").agg(
        F.sort_array(F.collect_list("path")).alias("paths"), F.first("columns").alias("columns")).orderBy("service_type", "schema_key").collect()


def _projected(df: DataFrame, service: str, names: list[str]) -> list[Column]:
    """Landing columns from a group's physical columns; values that don't fit the contract's type become NULL."""
    have = {n.lower(): n for n in names}
    out = []
    for f in LANDING_SCHEMA.fields:
        aliases = COLUMN_ALIASES[service].get(f.name)
        if aliases is None:
            if f.name in ("dispatching_base_num", "hvfhs_license_num", "trip_distance", "total_amount"):
                out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        found = next((have[a.lower()] for a in aliases if a.lower() in have), None)
        out.append((df[f"`{found}`"].try_cast(f.dataType) if found else F.lit(None).cast(f.dataType)).alias(f.name))
    return out


def _read(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Rows of all files: file_path, row number and the landing columns that come from the data."""
    parts = []
    for g in _groups(files):
        df = spark.read.parquet(*g["paths"])
        parts.append(df.select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file_path"), (F.col("_metadata.row_index") + 1).alias("source_row_number"),
                               *_projected(df, g["service_type"], [c["name"] for c in g["columns"]])))
    if not parts:
        fields = [f for f in LANDING_SCHEMA.fields if f.name in COLUMN_ALIASES["fhvhv"]]
        schema = ", ".join(["file_path string", "source_row_number long", *(f"{f.name} {f.dataType.simpleString()}" for f in fields)])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def pickup_months(spark: SparkSession, inspected: DataFrame) -> DataFrame:
    """Of every file with readable rows and known columns: rows (n) and rows picked up in the folder's month (in_month)."""
    files = valid_files(inspected)
    known = files.select("file_path", "year", "month")
    rows = _read(spark, files).select("file_path", "pickup_datetime").join(known, "file_path")
    inside = (F.year("pickup_datetime") == F.col("year")) & (F.month("pickup_datetime") == F.col("month"))
    return rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(inside, 1)).alias("in_month"))


def landing_rows_of(spark: SparkSession, files: DataFrame, source_kind: str = "tlc", manifest: DataFrame | None = None,
                    loaded_at: Column | None = None) -> DataFrame:
    """Landing rows of (valid, inspected) files, one file for each content.

    Of files with equal digests the one with the least path is read.  ``manifest``
    (sha256, file_id) keeps the ids it knows.
    """
    chosen = files.groupBy("sha256").agg(F.min("file_path").alias("file_path"))
    once = files.join(chosen, ["sha256", "file_path"])
    if manifest is not None:
        known = manifest.filter("sha256 is not null").groupBy("sha256").agg(F.min("file_id").alias("known_id"))
        once = once.join(known, "sha256", "left").withColumn("file_id", F.coalesce("known_id", "file_id"))
    names = once.select("file_path", "file_id", "file_name", "service_type")
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return _read(spark, once).join(names, "file_path").select(
        F.lit(source_kind).alias("source_kind"), F.col("file_id").alias("source_file_id"), F.col("file_name").alias("source_filename"),
        "source_row_number", "service_type", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "dropoff_location_id",
        "trip_distance", "total_amount", "dispatching_base_num", "hvfhs_license_num", stamp.cast("timestamp").alias("loaded_at"))
