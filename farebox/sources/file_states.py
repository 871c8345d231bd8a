"""File states as append-only events.

Every step of a file's life is one appended row; nothing is rewritten, so writers
can't lose each other's updates.  The current state is a fold over a file's
events: one partial aggregation by file key.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schemas import FILE_STATUSES, MANIFEST_KEY

MAX_RETRIES = 3

EVENT_SCHEMA = T.StructType([
    T.StructField("source_kind", T.StringType(), False),
    T.StructField("service_type", T.StringType(), False),
    T.StructField("year", T.ShortType(), False),
    T.StructField("month", T.ShortType(), False),
    T.StructField("filename", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("event_at", T.TimestampType(), False),
    T.StructField("sha256", T.StringType(), True),
    T.StructField("size_bytes", T.LongType(), True),
    T.StructField("row_count", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
])


def append_events(events: DataFrame, path: str) -> None:
    events.select([F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA.fields]).write.mode("append").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """All events, none before the first write.  Any other read error is raised."""
    try:
        return spark.read.schema(EVENT_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENT_SCHEMA)


def current_states(events: DataFrame) -> DataFrame:
    """One row a file: its last status and what is known of it.

    Of events at one time the one further on in the file's life counts.  An
    attempt is a DOWNLOADING event; ``retry_count`` is the number of attempts
    after the first.  Digest, size and row count are the last ones reported.
    """
    rank = F.array_position(F.array(*(F.lit(s) for s in FILE_STATUSES)), F.col("status"))
    when = F.struct("event_at", rank.alias("rank"), "run_id")
    attempt = F.col("status") == "DOWNLOADING"
    last_known = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c)
    return events.groupBy(*MANIFEST_KEY).agg(
        F.max_by("status", when).alias("status"),
        F.greatest(F.count(F.when(attempt, 1)) - 1, F.lit(0)).cast("int").alias("retry_count"),
        F.max(F.when(attempt, F.col("event_at"))).alias("last_attempt_at"),
        F.max_by("error_message", F.when(F.col("status").isin("FAILED", "QUARANTINED"), when)).alias("last_error"),
        last_known("sha256"), last_known("size_bytes"), last_known("row_count"),
        F.min_by("run_id", when).alias("first_run_id"), F.max_by("run_id", when).alias("last_run_id"),
        F.min("event_at").alias("created_at"), F.max("event_at").alias("updated_at"))


def files_to_fetch(inventory: DataFrame, states: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Inventory files with what to do: SKIPPED (done or quarantined), EXHAUSTED (failed too often), RETRY or DOWNLOAD."""
    key = list(MANIFEST_KEY)
    known = states.select(*key, "status", "retry_count")
    asked = inventory.withColumn("year", F.col("year").cast("short")).withColumn("month", F.col("month").cast("short"))
    action = (F.when(F.col("status").isin("VALIDATED", "PROCESSED", "QUARANTINED"), "SKIPPED")
              .when((F.col("status") == "FAILED") & (F.col("retry_count") >= max_retries), "EXHAUSTED")
              .when(F.col("status").isin("FAILED", "DOWNLOADING"), "RETRY").otherwise("DOWNLOAD"))
    return asked.join(known, key, "left").select(*asked.columns, action.alias("action"), F.coalesce("retry_count", F.lit(0)).alias("retry_count"))
