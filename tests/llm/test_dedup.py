"""Operators 2 and 3 against brute force."""

import hashlib
import random
import re
import subprocess
import sys
from collections import Counter, defaultdict
from functools import reduce
from pathlib import Path

import numpy as np

from farebox.llm.exact_dedup import Batch, DigestIndex, dedup_in_batches
from farebox.llm.near_dup import Filter, NearDuplicates, bins_of, near_duplicates

LOW = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, width, percent):
    """doc_id -> (set size, smallest reachable doc_id), by an inverted index over all shingles."""
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    having = defaultdict(list)
    for x in sorted(sets):
        shared = defaultdict(int)
        for s in sets[x]:
            for y in having[s]:
                shared[y] += 1
            having[s].append(x)
        for y, n in shared.items():
            if 100 * n >= percent * (len(sets[x]) + len(sets[y]) - n):
                a, b = sorted((find(x), find(y)))
                parent[b] = a
    return {i: (len(s), find(i)) for i, s in sets.items()}


def variants(seed, groups=12, size=25):
    """Groups of texts with a few words changed, some of which chain beyond the threshold, and single texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(120)]
        for _ in range(r.choice([1, 2, size])):
            now = list(base)
            for _ in range(r.choice([0, 1, 2, 5, 9])):
                now[r.randrange(len(now))] = word()
            rows.append(" ".join(now))
            if r.random() < 0.2:
                base = now
    r.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates_against_brute_force(spark, folder):
    rows = variants(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # small nodes: every path (branching, stars, blocks) is taken
    got = near_duplicates(df, folder, node_limit=4, depth=2).collect()
    want = brute(rows, 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len(set(c for _, c in want.values())) < len(rows)


def test_texts_just_under_the_threshold_are_not_dealt_again_and_again(spark, folder):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    base, rows = [word() for _ in range(150)], []
    for i in range(60):  # one dense group, with chains of links inside and texts linked with nothing
        now = list(base)
        for _ in range(r.choice([1, 2, 6])):
            now[r.randrange(150)] = word()
        rows.append((i, " ".join(now)))
    run = NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder, node_limit=8, block=16)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in run.run().collect()}
    assert got == brute(rows, 3, 85) and len(set(got.values())) > 5
    assert spark.read.parquet(f"{folder}/all-nodes").count() <= 2 * 60 * run.trees


def test_members_of_several_dense_nodes_do_not_all_ask_in_each(spark, folder):
    r = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(60):  # alike, and hardly two of them linked
        now = list(base)
        for k in r.sample(range(150), 6):
            now[k] = f"x{r.randrange(10**9)}"
        texts.append(" ".join(now))
    rows = list(enumerate(texts))
    run = NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder, node_limit=8, block=16)
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in run.run().collect()} == brute(rows, 3, 85)
    nodes = spark.read.parquet(f"{folder}/all-nodes").where("least is not null")
    sizes = [x["count"] for x in nodes.groupBy("node").count().collect()]
    dealt = run.deal(nodes, None, "test").count()  # as if no link were known
    assert len(sizes) > 2 and dealt < 0.9 * sum(n * -(-(n - 1) // 16) + (n - 1) * -(-n // 16) for n in sizes)


def test_near_duplicates_with_five_words(spark, folder):
    rows = variants(6, groups=6)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder, percent=80, width=5).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, 5, 80)


def test_near_duplicates_on_odd_rows(spark, odd, none, folder):
    got = near_duplicates(odd.selectExpr("*", "1 as kept", "2 as tokens"), f"{folder}/a").collect()
    assert len(got) == odd.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append((r.n_shingles, r.component_id, r.kept))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(3, 4, True)] and by[5] == [(3, 4, False)] * 2 and by[9] == [(1, 9, True)]
    assert by[None] == [(5, None, True)]
    assert near_duplicates(none, f"{folder}/b").collect() == []


def test_texts_that_share_a_doc_id_are_linked_each_for_itself(spark, folder):
    words = lambda seed: [f"w{random.Random(seed + k).randrange(10**6)}" for k in range(200)]
    near = lambda w, k: " ".join([*w[:k], "other", *w[k + 1:]])
    a, b = words(1), words(5000)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 5)), (4, near(a, 90)), (3, near(b, 7)), (5, near(b, 100)), (6, " ".join(words(9000)))]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), folder).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 6)]


def test_bins_keep_linked_pairs_and_drop_others():
    """Random sets of all sizes at the threshold pass; clearly below it they don't."""
    rng = np.random.default_rng(4)
    may, fresh = Filter(85), lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)

    def passed(n, similar):
        union = int(n)
        both = int(np.ceil(similar * union))
        shared, rest = fresh(both), fresh(union - both)
        cut = (union - both) // 2
        s, t = np.unique(np.concatenate([shared, rest[:cut]])), np.unique(np.concatenate([shared, rest[cut:]]))
        bins = bins_of([s, t])
        rows = may.pairs(bins[:1], bins[1:], np.array([len(s)]), np.array([len(t)]))[0]
        size = np.array([len(s), len(t)])
        assert (len(may.partners(0, np.array([1]), bins, (bins > 0).sum(1), size)[0]) == 1) == rows
        return rows

    for n in (1, 2, 7, 20, 60, 180, 500, 2000, 9000):
        assert all(passed(n, 0.85) for _ in range(150))
    assert sum(passed(180, 0.73) for _ in range(100)) < 10 and not any(passed(500, 0.6) for _ in range(50))
    assert not bins_of([np.empty(0, np.uint64)]).any()
    assert may.sizes(np.array([84, 85]), 100).tolist() == [False, True]


def test_exact_dedup_and_its_index(spark, folder):
    index = DigestIndex(spark, f"{folder}/index", buckets=4)
    first = spark.createDataFrame([(3, "a b"), (1, "ab"), (2, "a  b"), (4, None), (5, " \n"), (6, "c"), (6, "c"), (None, "d"), (7, "d")],
                                  "doc_id long, text string").selectExpr("*", "'x' as digest", "9 as kept")
    batch = Batch(first, index, f"{folder}/1")
    rows = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in batch.verdicts().collect()}
    assert rows == {(3, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (4, 5, 2, False), (5, 5, 2, True), (6, 6, 2, True),
                    (6, 6, 2, False), (None, 7, 2, False), (7, 7, 2, True)}
    assert {r.text_sha256 for r in batch.verdicts().collect() if r.doc_id == 1} == {hashlib.sha256(b"ab").hexdigest()}
    assert sorted(r.doc_id for r in batch.kept().collect()) == [2, 5, 6, 7]
    second = Batch(spark.createDataFrame([(10, "A B"), (11, "a\tb"), (12, "new")], "doc_id long, text string"), index, f"{folder}/2")
    assert {(r.doc_id, r.keep_id, r.kept) for r in second.verdicts().collect()} == {(10, 10, True), (11, 2, False), (12, 12, True)}
    assert index.table().count() == 6 and index.table().select("digest").distinct().count() == 6
    plan = index.new(second.held.select("digest"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Python" not in plan
    third = Batch(spark.createDataFrame([], "doc_id long, text string"), index, f"{folder}/3")
    assert third.verdicts().collect() == [] and third.kept().collect() == []


def test_a_repeated_batch_keeps_what_it_kept(spark, folder):
    """As after a failure between the index's append and the caller's write, and of an append that came half-way."""
    index = DigestIndex(spark, f"{folder}/index", buckets=4)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b "), (4, "c")], "doc_id long, text string")
    first = Batch(docs, index, f"{folder}/1", batch="monday")
    assert sorted(r.doc_id for r in first.kept().collect()) == [1, 3, 4]
    again = Batch(docs.repartition(3), index, f"{folder}/2", batch="monday")
    assert sorted(r.doc_id for r in again.kept().collect()) == [1, 3, 4] and index.table().count() == 3
    more = Batch(docs.union(spark.createDataFrame([(5, "d")], "doc_id long, text string")), index, f"{folder}/3", batch="monday")
    assert sorted(r.doc_id for r in more.kept().collect()) == [1, 3, 4, 5] and index.table().count() == 4
    assert Batch(docs, index, f"{folder}/4", batch="tuesday").kept().collect() == []


def test_batches_give_what_one_batch_gives(spark, folder):
    r = random.Random(2)
    rows = [(r.choice([None, *range(40)]), r.choice(["", None, " ", "ab", "a b", "a  b", "abc", "a bc ", "x" * 30, " ".join("x" * 30)])) for _ in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    see = lambda df: Counter(tuple(x) for x in df.select("keep_id", "group_size", "kept", "text_sha256").collect())
    whole = see(Batch(docs, DigestIndex(spark, f"{folder}/one"), f"{folder}/1").verdicts())
    for n in (2, 5):
        batches = dedup_in_batches(docs, DigestIndex(spark, f"{folder}/many-{n}"), f"{folder}/{n}", n)
        sizes = reduce(lambda a, b: a.union(b), (b.groups.select("digest", "group_size") for b in batches)).groupBy("digest").sum("group_size").toDF("digest", "group_size")
        assert see(reduce(lambda a, b: a.unionByName(b), (b.verdicts(sizes) for b in batches))) == whole
        assert sum(b.kept().count() for b in batches) == sum(n for row, n in whole.items() if row[2])
    assert dedup_in_batches(docs.where("false"), DigestIndex(spark, f"{folder}/none"), f"{folder}/0")[1].verdicts().collect() == []


def test_a_batch_writes_one_file_a_bucket_however_it_is_dealt(spark, folder, monkeypatch):
    """Files of each task and bucket would be their product, 328 here."""
    frame = type(spark.range(0))
    plain = frame.repartition
    monkeypatch.setattr(frame, "repartition", lambda self, n, *cols: plain(self, max(n, 41) if cols else n, *cols))
    index = DigestIndex(spark, f"{folder}/index", buckets=8)
    first = Batch(spark.createDataFrame([(i, f"text {i}") for i in range(1000)], "doc_id long, text string"), index, f"{folder}/1")
    assert len(index.table().inputFiles()) == 8 and len(first.kept().collect()) == 1000
    second = Batch(spark.createDataFrame([(i, f"text  {i}") for i in range(500, 1500)], "doc_id long, text string"), index, f"{folder}/2")
    assert len(index.table().inputFiles()) == 16 and {r.doc_id for r in second.kept().collect()} == set(range(1000, 1500))


EARLIER = """
import sys
from pyspark.sql import SparkSession
from farebox.llm.exact_dedup import Batch, DigestIndex
folder = sys.argv[1]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, None)], "doc_id long, text string")
Batch(docs, DigestIndex(spark, f"{folder}/index", buckets=4), f"{folder}/earlier").kept().collect()
"""


def test_digest_index_outlives_its_session(spark, folder):
    """Another process makes the index; this session finds its texts and appends to them."""
    subprocess.run([sys.executable, "-c", EARLIER, folder], check=True, timeout=120, cwd=Path(__file__).parents[2])
    index = DigestIndex(spark, f"{folder}/index")
    assert index.buckets == 4 and index.table().count() == 3
    later = Batch(spark.createDataFrame([(10, "ab"), (11, "new"), (12, "")], "doc_id long, text string"), index, f"{folder}/later")
    assert {(r.doc_id, r.keep_id, r.kept) for r in later.verdicts().collect()} == {(10, 1, False), (11, 11, True), (12, 3, False)}
    assert [r.doc_id for r in later.kept().collect()] == [11]
    assert sorted(r.keep_id for r in index.table().collect()) == [1, 2, 3, 11]
    plan = index.new(later.held.select("digest"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1  # of the batch only: the registered table keeps its buckets
