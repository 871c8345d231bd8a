"""Exact de-duplication against a persistent digest index (operator 3, native).

Texts are equal when they are identical after deleting every ASCII white-space
character.  The index is a table with one row for each text ever kept:
bucketed and sorted by the SHA-256 of the normalised text, so the sort-merge
anti-join that finds the new texts of a batch reads it without a shuffle; only
new digests are appended.

A batch is reduced to one row for each digest before it is shuffled (partial
aggregation), so a text that a third of all rows share costs a row for each
task.  The last join, which hands every row its verdict, has a shuffle on both
sides that adaptive execution splits where a digest is hot.

Cases.  Null text counts as empty; all empty texts are one group.  Of equal
texts the one with most code points stays, then the smallest doc_id (null
last); of rows that agree in all that, one.  A text that the index already
holds has its first keeper as ``keep_id`` and no row of the new batch stays.
An empty batch appends nothing.  Columns of the batch named like an output are
replaced.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents, scratch, store

#: ASCII white space, as a Java class.
WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """Adds the digest of the normalised text and the text's number of code points."""
    return (docs.withColumn("digest", F.unhex(F.sha2(normalised(F.col(text)).cast("binary"), 256)))
            .withColumn("n_points", F.char_length(F.coalesce(F.col(text), F.lit("")))))


class DigestIndex:
    """A bucketed table of digests in ``path``, known to the session's catalog as ``name``.

    The files outlive the session: one that doesn't know the table registers it
    from them.  ``buckets`` holds for a new index only; the number is kept in
    ``path`` + "-buckets", since files dealt to one number can't be read as another.
    Without ``name`` the name follows from the path, so all sessions use the same.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, buckets: int = 64) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.name = name or f"digest_index_{hashlib.sha256(self.path.encode()).hexdigest()[:16]}"
        beside = f"{self.path}-buckets"
        if self._files(beside):
            self.buckets = spark.read.schema("buckets int").json(beside).first()["buckets"]
        elif self._files(self.path):
            raise ValueError(f"{self.path} has files but {beside} has none: the index's number of buckets isn't known")
        else:
            self.buckets = buckets
            spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").json(beside)

    def _files(self, folder: str) -> bool:
        """Whether Spark has written part files there, in any store that Spark reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/part-*")
        return bool(path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path))

    def table(self) -> DataFrame | None:
        """The index, or None before the first batch."""
        if self.spark.catalog.tableExists(self.name):
            self.spark.catalog.refreshTable(self.name)  # another session may have appended
        elif self._files(self.path):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(self.path).schema)
            self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY (digest) SORTED BY (digest) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        else:
            return None
        return self.spark.table(self.name)

    def new(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest isn't in the index."""
        index = self.table()
        return groups if index is None else groups.join(index.select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        self.table()  # appending to files that the catalog doesn't know would overwrite them
        # by the number of the bucket, so that each is one file of the batch whatever the number of partitions; the write sorts it
        (groups.repartition(self.buckets, F.pmod(F.hash("digest"), F.lit(self.buckets)))
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))


OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")
_HELPERS = ("digest", "n_points", "row_id")


class Batch:
    """Rows that have gone through the index; new texts are in the index now.

    ``folder``: a shared folder for the rows with their digests, so that texts
    are hashed once.  ``keep_text=False`` leaves the text out there.  ``batch``: the
    caller's name of the batch.  A batch that is repeated under its name, after a
    failure anywhere, gets the verdicts that it got or would have got: only
    digests that the index lacks are appended, and those it holds under this name
    are this batch's own.
    """

    def __init__(self, docs: DataFrame, index: DigestIndex, folder: str, doc_id: str = "doc_id", text: str = "text",
                 keep_text: bool = True, batch: str | None = None) -> None:
        self.id = batch or uuid.uuid4().hex
        rows = keyed(docs.drop(*_HELPERS, *OUTPUTS), text).withColumn("row_id", F.monotonically_increasing_id())
        self.rows = store(rows if keep_text else rows.drop(text), f"{folder}/rows")
        best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col(doc_id).isNull().alias("none"),
                              F.col(doc_id).alias("id"), F.col("row_id").alias("row"))).alias("best")
        self.groups = store(self.rows.groupBy("digest").agg(best, F.count("*").alias("group_size"))
                            .select("digest", F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size"), f"{folder}/groups")
        index.append(index.new(self.groups).select("digest", "keep_id", "group_size", F.lit(self.id).alias("batch")))
        # one row a digest of this batch; the index's side is read by its buckets, without a shuffle
        known = index.table().select("digest", "keep_id", "group_size", "batch").hint("merge")
        self.held = store(self.groups.select("digest", "keep_row").join(known, "digest"), f"{folder}/held")

    def verdicts(self, sizes: DataFrame | None = None) -> DataFrame:
        """All rows with text_sha256, keep_id, group_size and kept.

        group_size: rows of the batch that brought the text, or of ``sizes`` (digest, group_size).
        """
        held = self.held if sizes is None else self.held.drop("group_size").join(sizes, "digest")
        return (self.rows.join(held, "digest")
                .withColumn("kept", (F.col("row_id") == F.col("keep_row")) & (F.col("batch") == self.id))
                .withColumn("text_sha256", F.lower(F.hex("digest")))
                .drop(*_HELPERS, "keep_row", "batch"))

    def kept(self) -> DataFrame:
        """The rows that stay, without added columns; shuffled by row number, so no text makes a task large."""
        stay = self.held.where(F.col("batch") == self.id).select(F.col("keep_row").alias("row_id"))
        return self.rows.join(stay, "row_id", "left_semi").drop(*_HELPERS)


def dedup_in_batches(docs: DataFrame, index: DigestIndex, folder: str, batches: int = 2, text: str = "text", **options: object) -> list[Batch]:
    """Passes a whole table through the index in batches, longest texts first.

    The batches are ranges of the number of code points, so the first batch that
    has a digest has the row of its group that stays, whatever the ranges; the
    anti-join drops the digest from all later ones.
    """
    points = F.char_length(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    cuts = docs.agg(F.percentile_approx(points, F.array(*(F.lit(x) for x in shares)))).first()[0] if shares else []
    bounds = [None, *(cuts or [0] * len(shares)), None]
    out = []
    for k, (high, low) in enumerate(zip(bounds, bounds[1:])):
        inside = F.lit(True) if high is None else points < high
        part = docs.where(inside if low is None else inside & (points >= low))
        out.append(Batch(part, index, f"{folder}/batch-{k}", text=text, batch=f"batch-{k}", **options))
    return out


def staying(docs: DataFrame, batches: list[Batch], folder: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay after ``dedup_in_batches`` of their ids and texts, read again instead of stored.

    A row that stays is known by its digest, length and doc_id, so the semi-join
    spreads a digest's rows by their ids.  Of rows that agree in all three one is taken.
    """
    key = ("digest", "n_points", "id")
    named = [b.rows.withColumn("id", F.col(doc_id)) for b in batches]
    keep = store(reduce(DataFrame.union, (
        rows.join(b.held.where(F.col("batch") == b.id).select(F.col("keep_row").alias("row_id")), "row_id", "left_semi").select(*key)
        for rows, b in zip(named, batches))), f"{folder}/keep")
    often = reduce(DataFrame.union, (rows.select(*key) for rows in named)).groupBy(*key).count().where("count > 1")
    same = lambda a, b: (a["digest"] == b["digest"]) & (a["n_points"] == b["n_points"]) & a["id"].eqNullSafe(b["id"])
    tied = store(keep.join(often, same(keep, often), "left_semi").select("digest"), f"{folder}/tied")
    rows = keyed(docs, text).withColumn("id", F.col(doc_id))
    rows = rows.join(keep, same(rows, keep), "left_semi").drop("n_points", "id")
    if not tied.isEmpty():
        rows = rows.join(tied, "digest", "left_anti").unionByName(rows.join(tied, "digest", "left_semi").dropDuplicates(["digest"]))
    return rows.drop("digest")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "exact-dedup")
    batches = dedup_in_batches(documents(spark, sf_dir), DigestIndex(spark, f"{folder}/index"), folder, keep_text=False)
    sizes = reduce(DataFrame.union, (b.groups.select("digest", "group_size") for b in batches))
    sizes = store(sizes.groupBy("digest").agg(F.sum("group_size").alias("group_size")), f"{folder}/sizes")
    return (reduce(DataFrame.unionByName, (b.verdicts(sizes) for b in batches))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


#: DuckDB has no octet view of a string with code points, so the digest is of the same normalised text.
ORACLE = r"""
with n as (select doc_id, coalesce(text, '') as t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm from documents),
h as (select doc_id, length(t) as points, sha256(norm) as text_sha256 from n)
select doc_id, first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = first_value(doc_id) over (partition by text_sha256 order by points desc, doc_id) as kept,
       text_sha256
from h
"""
