"""The pipeline: each stage's decisions on its own input."""

import os
import random
from pathlib import Path

import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from farebox.llm import common, toxicity
from farebox.llm.common import scratch, store, table
from farebox.llm.exact_dedup import normalised
from farebox.llm.packing import pack, pieces


def test_stages_on_a_table_with_planted_cases(spark, tmp):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents")
    r = random.Random(1)
    word = lambda: "".join(r.choice(("the", "re", "an", "in", "on", "er", "st", "nd")) for _ in range(r.randint(1, 3)))
    long = ". ".join(" ".join(word() for _ in range(14)).capitalize() for _ in range(16)) + "."
    planted = [(10_001, long), (10_002, long.replace(" ", "  ")), (10_003, long.replace(long.split()[40], "another", 1)), (10_004, None), (10_005, "")]
    extra = spark.createDataFrame([(i, t, "en", "p", len(t or "")) for i, t in planted], docs.schema)
    docs = docs.union(extra).selectExpr("*", "1 as score", "2 as kept", "3 as `row`", "4 as digest")
    folder, left = scratch(spark, "pipeline-test"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        before, docs = docs, spark.read.parquet(f"{folder}/{name}")
        left[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left[name] <= {r.doc_id for r in before.select("doc_id").collect()}
    assert {i for i, _ in planted} <= left["toxicity"]
    assert {10_001, 10_002, 10_003} <= left["quality"] and not {10_004, 10_005} & left["quality"]
    assert left["exact_dedup"] & {10_001, 10_002, 10_003} == {10_002, 10_003}  # most code points stay
    assert left["near_dedup"] & {10_001, 10_002, 10_003} == {10_002}
    assert left["packing"] == left["near_dedup"]
    assert docs.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048


def test_stages_on_an_empty_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.count() == 0, name


def test_toxicity_and_exact_dedup_store_no_texts(spark, folder, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = store(docs.union(docs.selectExpr("doc_id", "concat(text, ' ')", "lang", "source", "n_chars")).union(docs), f"{folder}/docs")
    for module in (corpus_pipeline, common):
        monkeypatch.setattr(module, "scratch", lambda _, name: f"{folder}/scratch/{name}")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    toxic = corpus_pipeline.toxicity(spark, docs, sf)
    left = corpus_pipeline.exact_dedup(spark, toxic, sf)
    out = store(left, f"{folder}/out")
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
    stored = list(Path(f"{folder}/scratch".removeprefix("file:")).rglob("*.parquet"))
    assert stored and not [f for f in stored if "text" in pq.read_schema(f).names]
    # of the two longest rows of each text, which agree in everything, one stays
    texts = [r.text for r in out.collect()]
    assert len({"".join((t or "").split()) for t in texts}) == len(texts) == toxic.select(normalised(F.col("text"))).distinct().count()
    assert out.columns == docs.columns and sum(t.endswith(" ") for t in texts if t) > 0.9 * len(texts)


def test_of_rows_that_agree_in_all_one_stays(spark):
    rows = [(1, "a b", "x"), (1, "a b", "y"), (1, "a  ", "x"), (None, "c", "x"), (None, "c", "x"), (None, "c", "z"), (2, "ab", "x"), (3, None, "x"),
            (None, "", "x"), (4, "d", "x"), (None, "d", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    left = corpus_pipeline.exact_dedup(spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.text) for r in left) == [("1", "a  "), ("1", "a b"), ("3", None), ("4", "d"), ("None", "c")]
    assert all(tuple(r) in rows for r in left)


def test_near_dedup_keeps_another_text_of_the_same_doc_id(spark):
    one, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, one, "x"), (2, one + " more", "x"), (2, other, "y"), (3, "short", "z"), (None, one + " end", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, number string")
    left = corpus_pipeline.near_dedup(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(map(tuple, left.collect())) == [rows[0], rows[2], rows[3]]


def test_stored_tables_have_no_marker_and_give_their_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "scratch", lambda _, name: f"{folder}/{name}")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    left = store(corpus_pipeline.near_dedup(spark, docs, ""), f"{folder}/out")
    packed = store(pack(pieces(left, public_tokenizers.path("word_bpe_49k.json")), f"{folder}/pack"), f"{folder}/packed")
    assert 0 < left.count() <= docs.count() and packed.select("doc_id").distinct().count() == left.count()
    files = [f.name for f in Path(folder.removeprefix("file:")).rglob("*") if f.is_file()]
    assert any(f.endswith(".parquet") for f in files) and "_SUCCESS" not in files


def test_the_driver_keeps_nothing_of_the_calibration(spark, monkeypatch):
    made, given = [], []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, value, f=type(spark.sparkContext).broadcast: made.append(f(sc, value)) or made[-1])
    monkeypatch.setattr(toxicity, "give_back", lambda: given.append(len(made)))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert corpus_pipeline.toxicity(spark, docs, "/root/testdata/sf0.01").count() <= docs.count()
    assert len(made) == 3 and given == [3]  # two settings are tried, one model is kept
    assert [os.path.exists(b._path) for b in made] == [False, False, True]
