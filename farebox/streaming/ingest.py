"""Landing ingest as a Structured Streaming job over Bronze files.

The stream's rows are files, not trips: the file source records in the query's
checkpoint which files it has handed out, so a rerun
(``trigger(availableNow=True)``) sees new files only.  Each micro-batch inspects
its files, reads the valid ones in groups of equal physical schema and appends
their rows under keys made of the file's digest and the row number.  So a file
delivered again under another name adds no row, and neither does a batch that
is repeated after a crash between the append and the stream's commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schemas import SERVICES
from farebox.session import checkpoint_dir
from farebox.sources.file_states import append_events
from farebox.sources.files import inspect_files, landing_rows_of, valid_files, validate_files
from farebox.sources.landing import append_landing

LISTING = "path string, modificationTime timestamp, length long, content binary"


def _events(inspected: DataFrame, source_kind: str, run_id: str) -> DataFrame:
    """PROCESSED or QUARANTINED (with the failed checks) for every file of a known service and month."""
    failed = (validate_files(inspected).filter("status = 'FAIL'").groupBy("file_path")
              .agg(F.concat_ws(", ", F.sort_array(F.collect_list("check_name"))).alias("failed")))
    known = inspected.filter(F.col("service_type").isin(*SERVICES) & F.col("year").isNotNull() & F.col("month").isNotNull())
    return known.join(failed, "file_path", "left").select(
        F.lit(source_kind).alias("source_kind"), "service_type", "year", "month", F.col("file_name").alias("filename"),
        F.when(F.col("failed").isNull(), "PROCESSED").otherwise("QUARANTINED").alias("status"), F.lit(run_id).alias("run_id"),
        F.current_timestamp().alias("event_at"), "sha256", F.col("length").alias("size_bytes"), F.col("num_rows").alias("row_count"),
        F.coalesce("error", "failed").alias("error_message"))


def ingest_files(spark: SparkSession, files: DataFrame, landing_path: str, source_kind: str = "tlc",
                 manifest: DataFrame | None = None, events_path: str | None = None, run_id: str = "ingest") -> int:
    """Lands the rows of listed files (file_path, path, length); returns the rows added.

    Files that fail a check are left out and, with ``events_path``, recorded with
    the reason beside the processed ones.
    """
    checkpoint_dir(spark)
    inspected = inspect_files(files).checkpoint(eager=True)   # files are hashed once
    added = append_landing(landing_rows_of(spark, valid_files(inspected), source_kind, manifest), landing_path)
    if events_path is not None:
        append_events(_events(inspected, source_kind, run_id), events_path)
    return added


def ingest_landing_stream(spark: SparkSession, bronze_dir: str, landing_path: str, checkpoint_location: str,
                          source_kind: str = "tlc", manifest: DataFrame | None = None, events_path: str | None = None,
                          files_a_batch: int = 64) -> int:
    """Consumes every new Bronze file below ``bronze_dir`` (service/year=/month= folders, any services); returns rows added.

    ``manifest`` (sha256, file_id) keeps the ids of files it knows; others get an
    id made of their digest.  The file source hands out no files without a byte,
    so those are met by :func:`farebox.sources.files.list_files` only.
    """
    stream = (spark.readStream.format("binaryFile").schema(LISTING).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files_a_batch).load(bronze_dir)
              .select(F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("file_path"), "path", "length"))
    counter = {"rows": 0}

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        counter["rows"] += ingest_files(batch.sparkSession, batch, landing_path, source_kind, manifest, events_path, f"batch-{batch_id}")

    checkpoint_dir(spark)
    query = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return counter["rows"]
