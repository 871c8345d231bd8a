"""Tables that are refreshed whole: versions beside each other and a pointer.

A refresh writes a new version folder and then appends one row to the table's
pointer, which readers resolve.  Nothing that can be read is overwritten, so a
write that fails half-way leaves the old version current, and a reader that has
resolved a version keeps it until it is expired.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "number long, version string, committed_at timestamp"


def _versions(spark: SparkSession, path: str) -> list:
    """Committed versions, newest first (one small row a refresh)."""
    try:
        return spark.read.schema(POINTER).json(f"{path}/pointer").orderBy(F.desc("number"), F.desc("version")).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def current_path(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, None before the first refresh."""
    versions = _versions(spark, path.rstrip("/"))
    return f"{path.rstrip('/')}/{versions[0]['version']}" if versions else None


def read_current(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """The current version.  ``schema``: for a partitioned table that may have no rows."""
    folder = current_path(spark, path)
    if folder is None:
        raise FileNotFoundError(f"{path} has no committed version")
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(folder)


def swap_in(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Writes ``df`` as a new version, makes it current and returns it as read from there."""
    spark, path = df.sparkSession, path.rstrip("/")
    version = f"version-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}")
    known = _versions(spark, path)
    number = known[0]["number"] + 1 if known else 0
    pointer = spark.createDataFrame([(number, version)], "number long, version string").withColumn("committed_at", F.current_timestamp())
    pointer.coalesce(1).write.mode("append").json(f"{path}/pointer")
    return spark.read.schema(df.schema).parquet(f"{path}/{version}").select(*df.columns)


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes the folders of all committed versions but the ``keep`` newest; returns how many were there."""
    jvm, removed = spark.sparkContext._jvm, 0
    for row in _versions(spark, path.rstrip("/"))[max(1, keep):]:
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{row['version']}")
        removed += bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))
    return removed
