"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from farebox.session import checkpoint_dir

#: Bytes of text handled at once inside a task; bounds a Python worker's memory.
SLICE_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Gives the tasks this package where the workers' import path doesn't have it (once for each context)."""
    sc, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    reachable = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if str(package.parent) in map(os.path.realpath, reachable) or getattr(sc, "_farebox_shipped", False):
        return
    bundle = os.path.join(tempfile.mkdtemp(prefix="farebox-code-"), "farebox.zip")
    with zipfile.ZipFile(bundle, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(bundle)
    sc._farebox_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of the whole table."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of the cluster."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Write options for tables of one run: no file _SUCCESS, which nothing reads.  On local disks Hadoop starts a process
#: from the driver for each file it makes, to set its permissions.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def store(df: DataFrame, path: str) -> DataFrame:
    """Writes a table and reads it again: cuts the lineage and survives lost executors."""
    df.write.options(**UNMARKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_fields(fields: list[StructField], added: str) -> StructType:
    """Schema of columns that pass through and of added ones (DDL)."""
    return StructType([*fields, *StructType.fromDDL(added).fields])


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key's decimal text, modulo ``parts`` (null key: the text '')."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def string_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One chunk of strings without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    return column


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, cut so that a slice holds about ``max_bytes`` of text (one row at least).

    Arrow's buffers of a worker come from the system's allocator, which gives
    them back when a slice is done; Arrow's own keeps them.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(byte_lengths(column))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def byte_lengths(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc
    return np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def ascii_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, text after text, and the number of words of each text."""
    import pyarrow.compute as pc
    lists = pc.ascii_split_whitespace(string_array(column))
    flat = lists.flatten()
    full = np.asarray(pc.binary_length(flat)) > 0
    bounds = np.asarray(lists.offsets, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(full)])
    if not full.all():
        flat = flat.filter(pa.array(full))
    return flat, np.diff(before[bounds - bounds[0]])


def per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``, of ``counts`` elements each."""
    out = np.zeros(len(counts), values.dtype)
    full = np.asarray(counts) > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(counts) - counts)[full])
    return out


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For jobs run inside: at most so many rows in an Arrow batch, which bounds executors' memory outside the heap
    where rows carry whole texts both ways."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def give_back() -> None:
    """What this process has freed goes back to the system; glibc would keep it for later."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(text))).first()[0] or 0


def components(links: DataFrame, folder: str) -> DataFrame:
    """(rep, comp) of all numbers in the pairs (a, b): comp is the least number that rep is connected with.

    Hooking and pointer jumping; each round is written under ``folder``, a shared one.
    """
    both = store(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{folder}/edges")
    labels = store(both.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), f"{folder}/labels-0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels.withColumnRenamed("rep", "b"), "b").groupBy(F.col("a").alias("rep"))
                .agg(F.min("comp").alias("near")))
        hooked = labels.join(near, "rep").select("rep", F.least("comp", "near").alias("hook"), "comp")
        up = labels.select(F.col("rep").alias("hook"), F.col("comp").alias("jump"))
        new = store(hooked.join(up, "hook").select("rep", F.least("hook", "jump").alias("new"), "comp"), f"{folder}/labels-{step}")
        labels = new.select("rep", F.col("new").alias("comp"))
        if new.where("new != comp").isEmpty():
            return labels
