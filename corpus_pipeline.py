"""The corpus pipeline: four stages filter ``documents``, the last packs what is left.

Cases.  Null texts count as empty; toxicity and quality judge every row for itself, so rows
that repeat share a verdict.  Of equal texts the longest stays, then that with the
least doc_id (null last); of near duplicates that with the least doc_id.  Empty tables
give empty results.

Every stage gets what its predecessor kept, written as Parquet and read again.
Toxicity and exact dedup keep no copy of the texts beside that.
A filtering stage returns whole rows with all columns of its input; the
operators see only doc_id and text (and the rest of the row as one column), so
no column of the input can clash with theirs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from farebox.llm.common import UNMARKED, arrow_rows, fold, scratch, ship, store, table
from farebox.llm.exact_dedup import DigestIndex, dedup_in_batches, staying
from farebox.llm.line_quality import quality_rules
from farebox.llm.near_dup import near_duplicates
from farebox.llm.packing import pack_documents
from farebox.llm import toxicity as toxic


def _carried(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``: all other columns."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in rest) if rest else [F.lit(0).alias("none")]).alias("row"))


def _restored(carried: DataFrame, docs: DataFrame) -> DataFrame:
    return carried.select(*(F.col(c) if c in ("doc_id", "text") else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model (learnt from the labelled ones outside the held-out fifth) doesn't reject."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    model = toxic.fit(docs.select("doc_id", "text").where(fold(F.col("doc_id"), 5) != 0).join(labels, "doc_id"))
    return docs.where(toxic.score(F.col("text"), model, spark) < 0.5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; their texts stay as they are."""
    return _restored(quality_rules(_carried(docs)).where("kept"), docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    folder = scratch(spark, "exact-dedup")
    batches = dedup_in_batches(docs.select("doc_id", "text"), DigestIndex(spark, f"{folder}/index"), folder, keep_text=False)
    return _restored(staying(_carried(docs), batches, folder), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8 or more): that with the least doc_id, null last."""
    ship(spark)
    folder = scratch(spark, "near-dup")
    # by row number, so that of two texts with one doc_id each has its own verdict
    rows = store(_carried(docs).withColumn("number", F.monotonically_increasing_id()), f"{folder}/rows")
    groups = near_duplicates(rows.select(F.col("number").alias("doc_id"), "text"), f"{folder}/groups", percent=80, width=5)
    member = rows.select("doc_id", "number").join(groups.select(F.col("doc_id").alias("number"), "component_id"), "number")
    stay = member.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "number"))["number"].alias("number"))
    return _restored(rows.join(stay, "number", "left_semi"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    ship(spark)
    with arrow_rows(spark, 2000):
        return pack_documents(docs, spark)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: The stages train models and run Python, which SQL can't express; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.options(**UNMARKED).parquet(path)
        docs = spark.read.parquet(path)
    return docs
