"""Near-duplicate groups by a chosen-path similarity join (operator 2).

Documents are sets of word shingles; documents whose sets have a Jaccard
similarity of at least the threshold are linked, and linked documents form
groups.

1. Sketch: every set gets a digest, a signature of minwise tokens, and bins: the
   set's hashes by their leading bits, of each bin a part of the least hash.
   Equal sets become one class, so exact copies cost one member.
2. Trees: in each independent tree a class goes to the node of one selected
   minwise token.  A node with more classes than ``node_limit`` branches: each
   member goes to the children of two more tokens that the node selects.  Two
   similar sets part at a branching with small odds only (both of two tokens
   must differ), so the number of trees follows from the threshold and the
   target recall.  Nodes with one member are dropped.  A node that has half of
   its members or more in one child is dense: its members are alike, so more
   branching would repeat them instead of parting them, and it ends there.
3. Stars: large nodes first compare all members with one of them.  What is
   linked so far gets a component.
4. Small nodes are compared exhaustively, by set sizes (exactly: the smaller must
   hold the threshold's share of the larger) and by bins.  First each member
   proposes its best partner of another component only; when those are confirmed
   and contracted, all pairs of different components that are left are proposed.
   Dense nodes, and large ones at the last level, are compared in blocks, but only
   members outside the node's largest component with the others: members of one
   component need no link.  A pair that shares several such nodes is compared in
   the least of them only; so where fewer members are outside the largest part
   that meets in another such node, those are compared with the others.
5. Candidates are confirmed on full sets (of 64-bit shingle hashes, computed
   again from the texts of candidates only), and components are found by
   hooking and pointer jumping.

No step holds an unbounded group: nodes are counted with partial aggregation, a
comparison holds at most two blocks, stars and hubs are joins that adaptive
execution can split.  Nothing is collected but counts.

Cases.  Null text, and text without words, has an empty set: linked with
nothing, its own group.  A text with fewer words than a shingle is one shingle.
Repeated rows have equal sets, so they share a class.  Classes have numbers of
their own, so several texts of one doc_id are linked each for itself, and every
row gets its own text's component.  Rows without a doc_id are linked with
nothing and kept.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ascii_words, components, documents, scratch, slices, store

TOKENS = 64  # minwise tokens of a signature
BINS = 1024  # of a set's hashes, by their leading bits; a power of two
DEVIATIONS = 6.0  # below the expected agreement of a pair at the threshold
NODE_LIMIT = 256
BLOCK = 1024  # members of a large node that meet as many others at once
DEPTH = 4
_MULTIPLIERS = np.random.default_rng(11).integers(1, 2**63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = ascii_words(pc.ascii_lower(texts))
    coded = words.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    h = distinct[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.uint64)
    rolled = np.full(len(h), np.uint64(width))
    for k in range(width):  # hash of the ``width`` words from each place on
        rolled = _mix(rolled + np.concatenate([h[k:], np.zeros(min(k, len(h)), np.uint64)]))
    out, a = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(rolled[a:a + n - width + 1]))
        else:
            whole = np.full(min(n, 1), np.uint64(n))
            for x in h[a:a + n]:
                whole = _mix(whole + x)
            out.append(whole)
        a += n
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise tokens (sets x TOKENS, 32 bits); all zero for an empty set."""
    out = np.zeros((len(sets), TOKENS), np.uint32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        joined = np.concatenate([sets[i] for i in full])
        starts = np.concatenate([[0], np.cumsum([len(sets[i]) for i in full])[:-1]])
        for k, m in enumerate(_MULTIPLIERS):
            out[full, k] = np.minimum.reduceat(((joined * m) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def trees_for(threshold: float, recall: float) -> int:
    """Independent trees so that a pair at the threshold meets in a small node of one of them."""
    kept = 1.0
    for _ in range(DEPTH):  # odds that a pair survives the branchings below the root
        kept = 1 - (1 - threshold * kept) ** 2
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * kept))


def bins_of(sets: list[np.ndarray]) -> np.ndarray:
    """Of every set (sorted hashes) and bin: 0 if the bin is empty, else a number from 1 to 255 made of its least hash."""
    out = np.zeros((len(sets), BINS), np.uint8)
    shift = np.uint64(65 - BINS.bit_length())
    for row, s in zip(out, sets):
        of = (s >> shift).astype(np.int64)
        least = np.flatnonzero(np.diff(of, prepend=-1))
        row[of[least]] = (_mix(s[least]) % np.uint64(255)).astype(np.uint8) + 1
    return out


class Filter:
    """Which pairs may reach the threshold, by sizes (exactly) and bins (but for small odds).

    The least hashes of the bins that the union of two sets fills are a random
    sample of the union, without replacement; a bin agrees if its hash is in both
    sets.  So of n filled bins a linked pair agrees in n * threshold at least,
    less what chance takes off; with as many bins filled as the union has members
    nothing is left to chance.
    """

    def __init__(self, percent: int) -> None:
        self.percent, self.threshold = percent, percent / 100

    def sizes(self, size: np.ndarray, other: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(size, other) >= self.percent * np.maximum(size, other)

    def agreement(self, same: np.ndarray, used: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether ``same`` of ``used`` bins suffice for two sets with ``sizes`` members together."""
        union = np.floor(sizes / (1 + self.threshold))  # the most that a linked pair's union has
        spread = np.sqrt(used * self.threshold * (1 - self.threshold) * np.maximum(union - used, 0) / np.maximum(union - 1, 1))
        return (used <= union) & (same >= used * self.threshold - DEVIATIONS * spread - 1)

    def pairs(self, bins: np.ndarray, other: np.ndarray, size: np.ndarray, other_size: np.ndarray) -> np.ndarray:
        """Row by row."""
        used, same = ((bins > 0) | (other > 0)).sum(1), ((bins == other) & (bins > 0)).sum(1)
        return self.sizes(size, other_size) & self.agreement(same, used, size + other_size)

    def partners(self, i: int, others: np.ndarray, bins: np.ndarray, filled: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of rows ``others``, those that may be linked with row i, and their share of agreeing bins.  ``filled``: bins filled of each row."""
        others = others[self.sizes(size[others], size[i])]
        mine = np.flatnonzero(bins[i])
        theirs = bins[np.ix_(others, mine)]
        same, used = (theirs == bins[i, mine]).sum(1), filled[others] + len(mine) - (theirs > 0).sum(1)
        fit = self.agreement(same, used, size[others] + size[i])
        return others[fit], same[fit] / np.maximum(used[fit], 1)


class NearDuplicates:
    """One run over (doc_id, text); intermediate tables lie in ``folder``, a shared folder."""

    def __init__(self, docs: DataFrame, folder: str, percent: int = 85, width: int = 3, recall: float = 0.99999,
                 node_limit: int = NODE_LIMIT, depth: int = DEPTH, block: int = BLOCK) -> None:
        self.spark, self.folder = docs.sparkSession, folder
        self.docs, self.percent, self.width = docs.select("doc_id", "text"), percent, width
        self.trees, self.filter = trees_for(percent / 100, recall), Filter(percent)
        self.limit, self.depth, self.block = node_limit, depth, block

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return store(df, f"{self.folder}/{name}")

    # -- 1. sketches and classes

    def sketches(self) -> DataFrame:
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                sets = shingle_sets(batch.column(1), width)
                tokens = signatures(sets).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * TOKENS, pa.int32()), pa.array(tokens.ravel())),
                     pa.array([row.tobytes() for row in bins_of(sets)], pa.binary())],
                    ["doc_id", "n_shingles", "digest", "tokens", "bins"])

        return self.docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, tokens array<int>, bins binary")

    # -- 2. trees

    def grow(self, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(node, n, rep, least) of all small nodes of two members or more and of dense ones; (leader, rep) of large nodes.

        ``least``: in a dense node, the least dense node of rep.
        """
        roots = F.array(*(F.struct(F.xxhash64(F.lit(t), F.element_at("tokens", t % TOKENS + 1)).alias("node")) for t in range(self.trees)))
        members = self.store(classes.select("rep", F.explode(roots).alias("r")).select(F.col("r.node").alias("node"), "rep"), "members-0")
        small, dense, stars = [], [], []
        for level in range(self.depth + 1):
            sizes = members.groupBy("node").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).where("n > 1")
            sized = self.store(members.join(sizes, "node"), f"sized-{level}")
            small.append(sized.where(F.col("n") <= self.limit))
            large = sized.where(F.col("n") > self.limit)
            if large.isEmpty():
                break
            stars.append(large.where("rep != leader").select("leader", "rep"))
            if level == self.depth:
                dense.append(large)
                break
            pick = [F.pmod(F.xxhash64("node", F.lit(k)), F.lit(TOKENS)).cast("int") for k in (1, 2)]
            child = F.explode(F.array(*(F.xxhash64("node", p, F.element_at("tokens", p + 1)) for p in pick)))
            grown = self.store(large.select("node", "n", "rep").join(classes, "rep")
                               .select(F.col("node").alias("parent"), "n", child.alias("node"), "rep").distinct(), f"members-{level + 1}")
            whole = grown.groupBy("parent", "node").agg(F.count("*").alias("m"), F.first("n").alias("n")).where("2 * m >= n").select("parent").distinct()
            dense.append(large.join(whole.withColumnRenamed("parent", "node"), "node", "left_semi"))
            members = grown.join(whole, "parent", "left_anti").select("node", "rep").distinct()
        none = sized.where("false")
        union = lambda parts: reduce(DataFrame.union, (p.select("node", "n", "leader", "rep") for p in parts), none.select("node", "n", "leader", "rep"))
        dense = union(dense).groupBy("rep").agg(F.collect_set(F.struct("node", "n")).alias("nodes"))
        self.shared = self.store(dense.select("rep", "nodes", F.col("nodes.node").alias("dense")), "dense-of")
        dense = self.shared.select("rep", F.array_min("dense").alias("least"), F.explode("nodes").alias("x")).select("x.node", "x.n", "rep", "least")
        return union(small).select("node", "n", "rep", F.lit(None).cast("long").alias("least")).union(dense), reduce(DataFrame.union, stars, none.select("leader", "rep")).distinct()

    # -- 3. and 4. candidates

    def likely(self, pairs: DataFrame, sketched: DataFrame) -> DataFrame:
        """The pairs (a, b) that may be links."""
        may = self.filter

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                s, t = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, BINS) for i in (2, 3))
                yield batch.select(["a", "b"]).filter(pa.array(may.pairs(s, t, *(np.asarray(batch.column(i)) for i in (4, 5)))))

        a = sketched.select(F.col("rep").alias("a"), F.col("bins").alias("s"), F.col("size").alias("m"))
        b = sketched.select(F.col("rep").alias("b"), F.col("bins").alias("t"), F.col("size").alias("n"))
        return pairs.join(a, "a").join(b, "b").select("a", "b", "s", "t", "m", "n").mapInArrow(run, "a long, b long")

    def deal(self, nodes: DataFrame, component: DataFrame | None, name: str) -> DataFrame:
        """The members of all nodes that hold several components, once for each block (node, i, j) that compares them."""
        rows = nodes if component is None else nodes.join(component, "rep", "left")
        rows = rows.withColumn("comp", F.col("rep") if component is None else F.coalesce("comp", "rep"))
        rows = self.store(rows, f"nodes-{name}")
        # of a node: its largest component (by a hash-free tie: the smallest id), and members outside it
        parts = rows.groupBy("node", "comp").agg(F.count("*").alias("m"), F.first("n").alias("n"))
        main = (parts.groupBy("node").agg(F.max(F.struct("m", (-F.col("comp")).alias("c"))).alias("x"), F.first("n").alias("size"))
                .select("node", (-F.col("x.c")).alias("main"), (F.col("size") - F.col("x.m")).alias("others")))
        # pairs of members with the same least dense node meet there, so the members outside the largest such part may ask instead
        parts = rows.where("least < node").groupBy("node", "least").agg(F.count("*").alias("m"), F.first("n").alias("n"))
        cover = (parts.groupBy("node").agg(F.max(F.struct("m", "least")).alias("x"), F.first("n").alias("size"))
                 .select("node", F.col("x.least").alias("cover"), (F.col("size") - F.col("x.m")).alias("rest")))
        main = (main.join(cover, "node", "left").withColumn("cover", F.when(F.col("rest") < F.col("others"), F.col("cover")))
                .select("node", "main", "cover", F.least("others", "rest").alias("others")).where("others > 0"))
        asks = F.when(F.col("cover").isNull(), F.col("comp") != F.col("main")).otherwise(F.col("least") != F.col("cover"))
        rows = rows.join(main, "node").withColumn("minor", (F.col("n") <= self.limit) | asks)
        block = F.lit(self.block)
        blocks_all = F.ceil(F.col("n") / block).cast("int")
        blocks_minor = F.ceil(F.col("others") / block).cast("int")
        own = lambda n: F.pmod(F.xxhash64("rep", "node"), n).cast("int")
        small = F.col("n") <= self.limit
        # small node: one group.  Large: every block of minor members meets every block of all members.
        as_any = rows.select("node", "rep", "comp", F.col("minor").alias("minor"), F.explode(
            F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks_minor - 1))).alias("i"),
            F.when(small, 0).otherwise(own(blocks_all)).alias("j"), F.when(small, F.lit(True)).otherwise(F.lit(False)).alias("query"))
        as_query = rows.where(~small & F.col("minor")).select("node", "rep", "comp", "minor", own(blocks_minor).alias("i"), F.explode(
            F.sequence(F.lit(0), blocks_all - 1)).alias("j"), F.lit(True).alias("query"))
        return as_any.union(as_query)

    def compare(self, nodes: DataFrame, sketched: DataFrame, component: DataFrame | None, best: bool) -> DataFrame:
        """Candidate pairs (a, b) of different components in all nodes; ``best``: of each member that with its best partner only."""
        groups = self.deal(nodes, component, str(best)).join(sketched, "rep")
        may = self.filter

        def run(rows: pa.Table) -> pa.Table:
            rep, comp = (np.asarray(rows[c].combine_chunks()) for c in ("rep", "comp"))
            query = np.asarray(rows["query"].combine_chunks())
            bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(-1, BINS)
            size = np.asarray(rows["size"].combine_chunks())
            filled = (bins > 0).sum(1)
            # a pair is compared in the least dense node that it shares; one bit for each such node of a row
            node, lists = rows["node"][0].as_py(), rows["dense"].combine_chunks()
            named, ids = np.asarray(pc.list_parent_indices(lists)), np.asarray(pc.list_flatten(lists), np.int64)
            known, at = np.unique(ids, return_inverse=True)
            met = np.zeros((len(rep), len(known)), bool)
            met[named, at] = True
            met = np.packbits(met[:, known < node] if node in known else met, axis=1)
            left, right = [], []
            for i in np.flatnonzero(query):
                others = np.flatnonzero(comp != comp[i])
                if met[i].any():
                    others = others[~(met[others] & met[i]).any(1)]
                if best:
                    found, agreement = may.partners(i, others, bins, filled, size)
                    found = found[[agreement.argmax()]] if len(found) else found
                else:
                    found, _ = may.partners(i, others[~query[others] | (others > i)], bins, filled, size)
                left.append(np.minimum(rep[found], rep[i]))
                right.append(np.maximum(rep[found], rep[i]))
            none = np.zeros(0, np.int64)
            return pa.table({"a": np.concatenate([*left, none]), "b": np.concatenate([*right, none])})

        return groups.groupBy("node", "i", "j").applyInArrow(run, "a long, b long").distinct()

    # -- 5. full sets and components

    def confirm(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are links."""
        width, percent = self.width, self.percent
        pairs = self.store(pairs, f"{name}-candidates")
        wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct().join(self.classes.select("rep", "digest", "first_id"), "rep")
        wanted = self.store(wanted, f"{name}-wanted")

        def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                sets = [s.tobytes() for s in shingle_sets(batch.column(1), width)]
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["digest", "full"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                linked = np.zeros(batch.num_rows, bool)
                for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                    s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    linked[i] = 100 * both >= percent * (len(s) + len(t) - both)
                yield batch.select(["a", "b"]).filter(pa.array(linked))

        # a class's first doc_id may have other texts too; the digest tells them apart, and equal digests are equal sets
        texts = self.docs.join(wanted.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi")
        sets = texts.mapInArrow(load, "digest binary, full binary").join(wanted.select("rep", "digest"), "digest").dropDuplicates(["rep"])
        sets = self.store(sets.select("rep", "full"), f"{name}-sets")
        a = sets.select(F.col("rep").alias("a"), F.col("full").alias("s"))
        b = sets.select(F.col("rep").alias("b"), F.col("full").alias("t"))
        return self.store(pairs.join(a, "a").join(b, "b").select("a", "b", "s", "t").mapInArrow(run, "a long, b long"), f"{name}-links")

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id and kept of every document."""
        sketches = self.store(self.sketches(), "sketches")
        full = sketches.where("n_shingles > 0 and doc_id is not null")
        first = (F.first(c).alias(c) for c in ("tokens", "bins", "n_shingles"))
        self.classes = self.store(full.groupBy("digest").agg(F.min("doc_id").alias("first_id"), *first)
                                  .withColumn("rep", F.monotonically_increasing_id()), "classes")
        sketched = self.classes.select("rep", "bins", F.col("n_shingles").alias("size"))
        nodes, stars = self.grow(self.classes.select("rep", "tokens"))
        nodes = self.store(nodes, "all-nodes")
        sketched = self.store(sketched.join(self.shared.select("rep", "dense"), "rep", "left"), "sketched")
        links, component = [], None
        for step in ("star", "best", "rest"):
            if step == "star":
                candidates = self.likely(stars.select(F.col("leader").alias("a"), F.col("rep").alias("b")), sketched)
            else:
                candidates = self.compare(nodes, sketched, component, step == "best")
            links.append(self.confirm(candidates, step))
            component = components(reduce(DataFrame.union, links), f"{self.folder}/{step}-components")
        named = self.classes.select("digest", "rep", "first_id").join(component, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        named = self.store(named.select("digest", "comp", "first_id"), "named")
        names = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
        grouped = (full.select("doc_id", "n_shingles", "digest").join(named.select("digest", "comp").join(names, "comp"), "digest")
                   .select("doc_id", "n_shingles", "component_id"))
        alone = sketches.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
        return grouped.union(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, folder: str, **options: object) -> DataFrame:
    return NearDuplicates(docs, folder, **options).run()


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), scratch(spark, "near-dup"), percent=85, width=3)
