"""Regression trees that Spark's own library doesn't have: extremely randomised
trees grown to the last rows, and leaf-wise boosting on histograms.

**Extra-trees.**  A node splits at the best of one random threshold a feature,
drawn between the node's least and greatest value.  The draw is a hash of the
seed, the tree, the node's path and the feature, so a forest doesn't depend on
how its rows are partitioned.  Nodes with more than ``group_rows`` rows split
level by level: one aggregation finds the ranges of all open nodes of all trees
and groups (forecast horizons), a second one the two sides of every threshold.
As soon as a node has no more rows than that, its rows are sent to one task,
which grows the rest of that branch.  So a task holds a bounded number of rows
and there are about 2 log2(rows / group_rows) jobs besides the last one.  The
splits above the branches (about 4 rows / group_rows nodes a tree) travel with
the tasks' code; branches stay in a table, and predictions are sent to them.

**Histogram boosting.**  Features are binned once into bytes.  A tree grows by the
best leaf first and needs of the rows only histograms: rows and gradient sums a
bin of a leaf.  A leaf's two children cost one histogram, of the smaller child:
the sibling's is the difference.  The children of all leaves that may still be
split are measured together, so a tree takes about as many rounds as it is deep.
A group of no more than ``group_rows`` rows is fitted inside one task.  Rows
of larger groups stay in a table of binned blocks and a round is one aggregation over it by
(node, bin); predictions are carried forward in that table every few trees.
Both ways share the growing of trees and give the same model, but for the
rounding of sums.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

GROUP_ROWS = 1 << 18  # rows of a forest's branch, or of a boosting fit, that one task handles


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _root(seed: int, tree: np.ndarray) -> np.ndarray:
    return _mix(np.asarray(tree).astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 + 1 & (1 << 64) - 1))


def _child(node: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(node * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64) + np.uint64(1))


def _thresholds(node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One threshold a node and feature, uniform between ``low`` and below ``high`` (nodes x features)."""
    share = _mix(node[:, None] * np.uint64(0xD1342543DE82EF95) + np.arange(1, low.shape[1] + 1, dtype=np.uint64)) >> np.uint64(11)
    cut = low + (high - low) * (share.astype(np.float64) / 2.0**53)
    return np.where(cut >= high, low, cut)


def _best_splits(n: np.ndarray, total: np.ndarray, n_left: np.ndarray, left: np.ndarray, low: np.ndarray, high: np.ndarray,
                 min_leaf: int) -> np.ndarray:
    """Feature with the greatest reduction of the squared error of each node, -1 without an allowed split."""
    n_right, right = n[:, None] - n_left, total[:, None] - left
    allowed = (n_left >= min_leaf) & (n_right >= min_leaf) & (high > low)
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where(allowed, left**2 / n_left + right**2 / n_right, -np.inf)
    best = score.argmax(1)
    return np.where(allowed.any(1), best, -1)


@dataclass
class Tree:
    """Nodes of one branch; ``left`` is the index of the left child (the right one follows), -1 in a leaf."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        inner = np.flatnonzero(self.left[at] >= 0)
        while len(inner):
            node = at[inner]
            at[inner] = self.left[node] + (x[inner, self.feature[node]] > self.threshold[node])
            inner = inner[self.left[at[inner]] >= 0]
        return self.value[at]


def grow_branch(x: np.ndarray, y: np.ndarray, node: int, min_leaf: int) -> Tree:
    """Grows all of a branch from its rows, level by level.  ``node``: hash of its first node's path."""
    width = x.shape[1]
    feature, threshold, left, value = [], [], [], []
    rows, starts, paths = np.arange(len(y)), np.zeros(1, np.int64), np.array([node], np.uint64)
    made = 1
    while len(starts):
        sizes = np.diff(np.append(starts, len(rows)))
        xs, ys = x[rows], y[rows]
        total = np.add.reduceat(ys, starts)
        low, high = np.minimum.reduceat(xs, starts), np.maximum.reduceat(xs, starts)
        varied = np.maximum.reduceat(ys, starts) > np.minimum.reduceat(ys, starts)
        cut = _thresholds(paths, low, high)
        of = np.repeat(np.arange(len(starts)), sizes)
        goes_left = xs <= cut[of]
        n_left = np.add.reduceat(goes_left, starts, dtype=np.int64)
        left_sum = np.add.reduceat(np.where(goes_left, ys[:, None], 0.0), starts)
        best = _best_splits(sizes, total, n_left, left_sum, low, high, min_leaf)
        best = np.where((sizes >= 2 * min_leaf) & varied, best, -1)
        split = best >= 0
        feature.append(best.astype(np.int32))
        threshold.append(np.where(split, cut[np.arange(len(best)), np.minimum(best, width - 1)], np.nan))
        value.append(total / sizes)
        first_child = made + 2 * (np.cumsum(split) - 1)
        left.append(np.where(split, first_child, -1))
        made += 2 * int(split.sum())
        # rows of split nodes, by child
        keep = split[of]
        side = ~goes_left[np.arange(len(rows)), np.maximum(best, 0)[of]]
        child = 2 * (np.cumsum(split) - 1)[of] + side
        order = np.argsort(child[keep], kind="stable")
        rows = rows[keep][order]
        counts = np.stack([n_left[split, best[split]], sizes[split] - n_left[split, best[split]]], 1).ravel()
        starts = np.cumsum(counts) - counts
        paths = _child(np.repeat(paths[split], 2), np.tile([0, 1], int(split.sum())))
    return Tree(*(np.concatenate(v) for v in (feature, threshold, left, value)))


# -- extra-trees ----------------------------------------------------------------------------


class Upper:
    """The splits above the branches: of every group and tree, by node path."""

    def __init__(self, seed: int, trees: int) -> None:
        self.seed, self.trees = seed, trees
        self.path = np.empty(0, np.uint64)
        self.feature, self.threshold = np.empty(0, np.int64), np.empty(0)

    def add(self, path: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> None:
        path = np.concatenate([self.path, path])
        order = np.argsort(path)
        self.feature = np.concatenate([self.feature, feature])[order]
        self.threshold = np.concatenate([self.threshold, threshold])[order]
        self.path = path[order]

    def route(self, group: int, tree: int, x: np.ndarray) -> np.ndarray:
        """The path of the deepest node that each row reaches."""
        at = np.full(len(x), _root(self.seed, np.array([group * self.trees + tree]))[0])
        rows = np.arange(len(x)) if len(self.path) else np.empty(0, np.int64)
        while len(rows):
            i = np.minimum(np.searchsorted(self.path, at[rows]), len(self.path) - 1)
            inner = self.path[i] == at[rows]
            rows, i = rows[inner], i[inner]
            at[rows] = _child(at[rows], x[rows, self.feature[i]] > self.threshold[i])
        return at


def _matrix(batch: pa.RecordBatch, features: Sequence[str]) -> np.ndarray:
    return np.stack([np.asarray(batch.column(batch.schema.get_field_index(f)), np.float64) for f in features], 1)


class ExtraTrees:
    """``trees`` extremely randomised trees for every value of the integer column ``group``.

    Missing values aren't handled: features and targets must not be null.
    """

    def __init__(self, features: Sequence[str], target: str, group: str, folder: str, trees: int = 120, min_leaf: int = 2,
                 seed: int = 42, group_rows: int = GROUP_ROWS) -> None:
        self.features, self.target, self.group, self.folder = list(features), target, group, folder.rstrip("/")
        self.trees, self.min_leaf, self.group_rows = trees, min_leaf, group_rows
        self.upper, self.jobs = Upper(seed, trees), 0
        self.seed = seed

    @property
    def branches(self) -> str:
        """Folder of the table of branches."""
        return f"{self.folder}/branches"

    def fit(self, rows: DataFrame) -> ExtraTrees:
        """Grows the forests; ``rows`` is read once a level above the branches and once more, so store it first."""
        data = rows.select(F.col(self.group).cast("int").alias("grp"), F.col(self.target).cast("double").alias("y"),
                           *(F.col(f).cast("double").alias(f) for f in self.features))
        sizes = {r["grp"]: r["n"] for r in data.groupBy("grp").agg(F.count("*").alias("n")).collect()}
        open_nodes = np.array([_root(self.seed, np.array([g * self.trees + t]))[0]
                               for g, n in sorted(sizes.items()) if n > self.group_rows for t in range(self.trees)], np.uint64)
        while len(open_nodes):
            open_nodes = self._level(data, np.sort(open_nodes))
        self._grow(data)
        return self

    def _aggregate(self, data: DataFrame, nodes: np.ndarray, cuts: np.ndarray | None) -> dict[str, np.ndarray]:
        """Of open nodes: rows, sum, least and greatest target and value; with ``cuts``, rows and sum left of each."""
        self.jobs += 1
        upper, features = self.upper, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, y, group = _matrix(batch, features), np.asarray(batch.column(1)), np.asarray(batch.column(0))
                for g in np.unique(group):
                    mine = np.flatnonzero(group == g)
                    for tree in range(upper.trees):
                        at = upper.route(int(g), tree, x[mine])
                        i = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
                        hit = nodes[i] == at
                        if not hit.any():
                            continue
                        i, rows = i[hit], mine[hit]
                        order = np.argsort(i, kind="stable")
                        i, rows = i[order], rows[order]
                        starts = np.flatnonzero(np.append(True, i[1:] != i[:-1]))
                        xs, ys = x[rows], y[rows]
                        out = {"node": i[starts], "n": np.diff(np.append(starts, len(rows))), "total": np.add.reduceat(ys, starts)}
                        if cuts is None:
                            out |= {"a": np.minimum.reduceat(xs, starts), "b": np.maximum.reduceat(xs, starts),
                                    "low_y": np.minimum.reduceat(ys, starts), "high_y": np.maximum.reduceat(ys, starts)}
                        else:
                            left = xs <= cuts[i]
                            out |= {"a": np.add.reduceat(left, starts, dtype=np.int64).astype(float),
                                    "b": np.add.reduceat(np.where(left, ys[:, None], 0.0), starts),
                                    "low_y": np.zeros(len(starts)), "high_y": np.zeros(len(starts))}
                        lists = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(out["node"]), pa.array(out["n"]), pa.array(out["total"]), pa.array(out["low_y"]), pa.array(out["high_y"]),
                             lists(out["a"]), lists(out["b"])], ["node", "n", "total", "low_y", "high_y", "a", "b"])

        partial = data.mapInArrow(run, "node long, n long, total double, low_y double, high_y double, a array<double>, b array<double>")
        first, second = (F.min, F.max) if cuts is None else (F.sum, F.sum)
        each = range(len(features))
        whole = partial.groupBy("node").agg(
            F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low_y").alias("low_y"), F.max("high_y").alias("high_y"),
            F.array(*(first(F.col("a")[k]) for k in each)).alias("a"), F.array(*(second(F.col("b")[k]) for k in each)).alias("b"))
        got = whole.orderBy("node").toArrow()
        column = lambda c: np.asarray(got[c].combine_chunks())
        square = lambda c: np.asarray(got[c].combine_chunks().flatten()).reshape(-1, len(features))
        return {c: column(c) for c in ("node", "n", "total", "low_y", "high_y")} | {c: square(c) for c in ("a", "b")}

    def _level(self, data: DataFrame, nodes: np.ndarray) -> np.ndarray:
        """Splits the open nodes (sorted) and returns those of their children that are too large for a task."""
        ranges = self._aggregate(data, nodes, None)
        low, high = ranges["a"], ranges["b"]
        cuts = _thresholds(nodes, low, high)
        sides = self._aggregate(data, nodes, cuts)
        best = _best_splits(sides["n"], sides["total"], sides["a"], sides["b"], low, high, self.min_leaf)
        best = np.where(ranges["high_y"] > ranges["low_y"], best, -1)
        split = np.flatnonzero(best >= 0)  # a large node without a split is left to a task, which makes it a leaf
        path, feature = nodes[split], best[split]
        self.upper.add(path, feature, cuts[split, feature])
        n_left = sides["a"][split, feature]
        children = np.concatenate([_child(path, np.zeros(len(path))), _child(path, np.ones(len(path)))])
        return children[np.concatenate([n_left, sides["n"][split] - n_left]) > self.group_rows]

    def _routed(self, data: DataFrame) -> DataFrame:
        """Rows of every tree by branch (tree and node path): the second column's and the features' bytes, row after row."""
        upper, features = self.upper, self.features

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x, group = _matrix(batch, features), np.asarray(batch.column(0))
                packed = np.column_stack([np.asarray(batch.column(1)).view(np.float64), x])
                for g in np.unique(group):
                    mine = np.flatnonzero(group == g)
                    for tree in range(upper.trees):
                        path = upper.route(int(g), tree, x[mine]).view(np.int64)
                        order = np.argsort(path, kind="stable")
                        starts = np.flatnonzero(np.append(True, np.diff(path[order]) != 0))
                        parts = [packed[rows].tobytes() for rows in np.split(mine[order], starts[1:])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(parts), g, np.int32)), pa.array(np.full(len(parts), tree, np.int32)),
                             pa.array(path[order][starts]), pa.array(parts, pa.binary())], ["grp", "tree", "path", "packed"])

        return data.mapInArrow(run, "grp int, tree int, path long, packed binary")

    def _unpacked(self, rows: pa.Table) -> np.ndarray:
        return np.frombuffer(b"".join(rows["packed"].to_pylist())).reshape(-1, 1 + len(self.features))

    def _grow(self, data: DataFrame) -> None:
        self.jobs += 1
        unpacked, min_leaf = self._unpacked, self.min_leaf

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            values = unpacked(rows)
            values = values[np.lexsort(values.T[::-1])]  # an order of their own, so that sums don't depend on how rows came
            tree = grow_branch(np.ascontiguousarray(values[:, 1:]), values[:, 0], int(np.int64(key[2].as_py()).view(np.uint64)), min_leaf)
            return pa.table({**dict(zip(("grp", "tree", "path"), ([k.as_py()] for k in key))),
                             **{c: [getattr(tree, c).tobytes()] for c in ("feature", "threshold", "left", "value")}},
                            schema=pa.schema([("grp", pa.int32()), ("tree", pa.int32()), ("path", pa.int64()),
                                              *((c, pa.binary()) for c in ("feature", "threshold", "left", "value"))]))

        grown = self._routed(data).groupBy("grp", "tree", "path").applyInArrow(
            run, "grp int, tree int, path long, feature binary, threshold binary, left binary, value binary")
        grown.write.parquet(self.branches)

    def upper_table(self, spark: SparkSession) -> DataFrame:
        """One row per split above the branches: node path, feature and threshold."""
        u = self.upper
        rows = [(int(p), self.features[f], float(t)) for p, f, t in zip(u.path.view(np.int64), u.feature, u.threshold)]
        return spark.createDataFrame(rows, "path long, feature string, threshold double")

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``prediction``, the mean of the trees."""
        spark, features, unpacked = rows.sparkSession, self.features, self._unpacked
        path = f"{self.folder}/rows-{uuid.uuid4().hex[:12]}"
        rows.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
        numbered = spark.read.parquet(path)
        data = numbered.select(F.col(self.group).cast("int").alias("grp"), "_row", *(F.col(f).cast("double").alias(f) for f in features))
        # a branch may get any number of rows: they come in blocks of bounded size, each with the branch
        blocks = max(1, -(-numbered.count() // self.group_rows))
        routed = self._routed(data).withColumn("block", F.pmod(F.xxhash64("packed"), F.lit(blocks)).cast("int"))
        branches = spark.read.parquet(self.branches).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        keys = ["grp", "tree", "path", "block"]

        def run(rows: pa.Table, branch: pa.Table) -> pa.Table:
            values = unpacked(rows)
            if not len(values):
                return pa.table({"_row": pa.array([], pa.int64()), "value": pa.array([], pa.float64())})
            tree = Tree(*(np.frombuffer(branch[c][0].as_py(), t) for c, t in
                          (("feature", np.int32), ("threshold", np.float64), ("left", np.int64), ("value", np.float64))))
            return pa.table({"_row": np.ascontiguousarray(values[:, 0]).view(np.int64), "value": tree.predict(values[:, 1:])})

        votes = routed.groupBy(*keys).cogroup(branches.groupBy(*keys)).applyInArrow(run, "_row long, value double")
        mean = votes.groupBy("_row").agg((F.sum("value") / self.trees).alias("prediction"))
        return numbered.join(mean, "_row").drop("_row")


# -- histogram boosting -----------------------------------------------------------------------


@dataclass
class BinnedTree:
    """A boosted tree over bins: ``left`` as in :class:`Tree`; rows with a bin up to ``cut`` go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def predict(self, bins: np.ndarray) -> np.ndarray:
        at = np.zeros(len(bins), np.int64)
        inner = np.flatnonzero(self.left[at] >= 0)
        while len(inner):
            node = at[inner]
            at[inner] = self.left[node] + (bins[inner, self.feature[node]] > self.cut[node])
            inner = inner[self.left[at[inner]] >= 0]
        return self.value[at]


@dataclass
class BoostedTrees:
    """A fitted model: bin edges, start value and trees (iterations x leaves nodes, whatever the rows)."""

    features: list[str]
    edges: list[np.ndarray]
    start: float
    trees: list[BinnedTree]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(self.edges)], 1).astype(np.uint8)

    def predict(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``prediction``."""
        chosen = rows.withColumn("prediction", F.lit(0.0))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins = self.bins(_matrix(batch, self.features))
                out = np.full(batch.num_rows, self.start)
                for tree in self.trees:
                    out += tree.predict(bins)
                yield batch.set_column(batch.num_columns - 1, "prediction", pa.array(out))

        return chosen.mapInArrow(run, chosen.schema)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per node."""
        def edge(t: BinnedTree, i: int) -> float | None:
            cuts = self.edges[t.feature[i]]
            return float(cuts[t.cut[i]]) if t.left[i] >= 0 and t.cut[i] < len(cuts) else None

        rows = [(k, i, self.features[t.feature[i]] if t.left[i] >= 0 else None, edge(t, i), int(t.left[i]) if t.left[i] >= 0 else None, float(t.value[i]))
                for k, t in enumerate(self.trees) for i in range(len(t.left))]
        return spark.createDataFrame([(-1, 0, None, None, None, self.start), *rows],
                                     "tree int, node int, feature string, threshold double, left_child int, value double")


class LocalRows:
    """Rows of a tree's nodes in one task."""

    def __init__(self, codes: np.ndarray, width: int) -> None:
        self.codes, self.width = codes, width  # codes: bin + offset of its feature

    def start(self, rows: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        """The histogram of all ``rows``, which are node 0 of a new tree."""
        self.gradient, self.held = gradient, {0: rows}
        return self._histogram(rows)

    def _histogram(self, rows: np.ndarray) -> np.ndarray:
        return histogram(self.codes[rows], self.gradient[rows], self.width)

    def measure(self, splits: list[tuple[int, int, int, int, int]]) -> list[np.ndarray]:
        """For (node, feature, code, left child, child to measure): the histogram of that child (the right child follows the left)."""
        out = []
        for node, feature, code, left, wanted in splits:
            rows = self.held[node]
            goes_left = self.codes[rows, feature] <= code
            self.held[left], self.held[left + 1] = rows[goes_left], rows[~goes_left]
            out.append(self._histogram(self.held[wanted]))
        return out


def histogram(codes: np.ndarray, gradient: np.ndarray, width: int) -> np.ndarray:
    """Rows and gradient sum of every bin (2 x width)."""
    flat = codes.ravel()
    return np.stack([np.bincount(flat, minlength=width).astype(float),
                     np.bincount(flat, np.repeat(gradient, codes.shape[1]), width)])


class SharedRows:
    """Rows in a table of blocks (group, codes, target, held, prediction), measured by one aggregation a round."""

    def __init__(self, blocks: DataFrame, width: int, offsets: np.ndarray, folder: str, carry: int = 8) -> None:
        self.blocks, self.width, self.offsets, self.folder, self.carry = blocks, width, offsets, folder, carry
        self.recent: list[BinnedTree] = []  # trees that the table's predictions don't hold yet
        self.stored = 0

    def _mapped(self, work, schema: str) -> DataFrame:
        """``work(codes, target, held, prediction)`` of every block, with the recent trees added."""
        offsets, recent = self.offsets, list(self.recent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for code, target, held, prediction in zip(*(c.to_pylist() for c in batch.columns)):
                    codes = np.frombuffer(code, np.int16).reshape(-1, len(offsets) - 1)
                    guess = np.frombuffer(prediction).copy()
                    for tree in recent:
                        guess += tree.predict(codes - offsets[:-1])
                    yield work(codes, np.frombuffer(target), np.frombuffer(held, bool), guess)

        return self.blocks.select("codes", "target", "held", "prediction").mapInArrow(run, schema)

    def _sums(self, work) -> dict[int, np.ndarray]:
        """Histograms by node; ``work`` gives (node, rows' codes, gradient) of a block."""
        width = self.width

        def rows(codes: np.ndarray, target: np.ndarray, held: np.ndarray, guess: np.ndarray) -> pa.RecordBatch:
            parts = [(node, histogram(c, g, width)) for node, c, g in work(codes[~held], (guess - target)[~held])]
            full = [(node, np.flatnonzero(h[0]), h) for node, h in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(at), node) for node, at, _ in full] or [np.zeros(0, np.int64)]).astype(np.int64)),
                 pa.array(np.concatenate([at for _, at, _ in full] or [np.zeros(0, np.int64)]).astype(np.int64)),
                 *(pa.array(np.concatenate([h[k][at] for _, at, h in full] or [np.zeros(0)])) for k in (0, 1))], ["node", "code", "n", "g"])

        got = self._mapped(rows, "node long, code long, n double, g double").groupBy("node", "code").agg(
            F.sum("n").alias("n"), F.sum("g").alias("g")).toArrow()
        node, code, n, g = (np.asarray(got[c].combine_chunks()) for c in ("node", "code", "n", "g"))
        out: dict[int, np.ndarray] = {}
        for k in np.unique(node):
            out[int(k)] = np.zeros((2, width))
            at = node == k
            out[int(k)][0, code[at]], out[int(k)][1, code[at]] = n[at], g[at]
        return out

    def start(self) -> np.ndarray:
        self.tree: dict[int, tuple[int, int, int]] = {}  # of split nodes: feature, code, left child
        return self._sums(lambda codes, gradient: [(0, codes, gradient)]).get(0, np.zeros((2, self.width)))

    def measure(self, splits: list[tuple[int, int, int, int, int]]) -> list[np.ndarray]:
        for node, feature, code, left, _ in splits:
            self.tree[node] = (feature, code, left)
        wanted, tree = [s[4] for s in splits], dict(self.tree)

        def work(codes: np.ndarray, gradient: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            held, open_nodes = {0: np.arange(len(codes))}, [0]
            while open_nodes:
                node = open_nodes.pop()
                if node in tree:
                    feature, code, left = tree[node]
                    goes_left = codes[held[node], feature] <= code
                    held[left], held[left + 1] = held[node][goes_left], held[node][~goes_left]
                    open_nodes += [left, left + 1]
            for node in wanted:
                yield node, codes[held[node]], gradient[held[node]]

        sums = self._sums(work)
        return [sums.get(node, np.zeros((2, self.width))) for node in wanted]

    def add(self, tree: BinnedTree) -> None:
        self.recent.append(tree)
        if len(self.recent) < self.carry:
            return
        done = self._mapped(lambda codes, target, held, guess: pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in (codes, target, held, guess)], ["codes", "target", "held", "prediction"]),
            "codes binary, target binary, held binary, prediction binary")
        self.stored += 1
        done.write.parquet(f"{self.folder}/blocks-{self.stored}")
        self.blocks, self.recent = done.sparkSession.read.schema(done.schema).parquet(f"{self.folder}/blocks-{self.stored}"), []

    def held_loss(self) -> float:
        parts = self._mapped(lambda codes, target, held, guess: pa.RecordBatch.from_arrays(
            [pa.array([float((((guess - target)[held]) ** 2).sum())])], ["loss"]), "loss double")
        return parts.agg(F.sum("loss")).first()[0] or 0.0


@dataclass
class Boosting:
    """How trees grow: squared error, best leaf first."""

    iterations: int = 120
    rate: float = 0.08
    leaves: int = 31
    l2: float = 0.1
    min_leaf: int = 20
    patience: int | None = 10  # rounds without a lower loss on held-out rows that end a fit of more than 10,000 rows
    held_share: float = 0.1
    seed: int = 42

    def best_split(self, h: np.ndarray, offsets: np.ndarray) -> tuple[float, int, int]:
        """Gain, feature and code of the best split of a histogram; gain 0 without one."""
        first, last = offsets[:-1], offsets[1:]
        feature_of = np.repeat(np.arange(len(first)), np.diff(offsets))
        sums = np.cumsum(h, axis=1)
        n, g = sums - np.concatenate([np.zeros((2, 1)), sums], axis=1)[:, first][:, feature_of]
        n_all, g_all = n[last[0] - 1], g[last[0] - 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = g * g / (n + self.l2) + (g_all - g) ** 2 / (n_all - n + self.l2) - g_all * g_all / (n_all + self.l2)
        gain[(n < self.min_leaf) | (n_all - n < self.min_leaf) | ~np.isfinite(gain)] = 0.0
        at = int(gain.argmax())
        return float(gain[at]), int(feature_of[at]), at

    def grow(self, root: np.ndarray, measure, offsets: np.ndarray) -> tuple[BinnedTree, np.ndarray]:
        """The tree from its root's histogram, and the numbers its nodes have for ``measure``."""
        hist, best = {0: root}, {0: self.best_split(root, offsets)}
        heap = [(-best[0][0], 0)] if best[0][0] > 0 else []
        left: dict[int, int] = {}  # of measured splits: the left child
        order, taken = [0], {}
        made = 1
        while heap and len(taken) + 1 < self.leaves:
            if heap[0][1] not in left:  # measure the children of all leaves that may still be split, together
                ask = []
                for _, k in heapq.nsmallest(self.leaves - 1 - len(taken), heap):
                    if k not in left:
                        _, f, code = best[k]
                        n_left, n = (hist[k][0, offsets[f]:end].sum() for end in (code + 1, offsets[f + 1]))
                        left[k] = made
                        ask.append((k, f, code, made, made if 2 * n_left <= n else made + 1))
                        made += 2
                for (k, _, _, child, wanted), h in zip(ask, measure(ask)):
                    hist[wanted], hist[2 * child + 1 - wanted] = h, hist[k] - h
                    best |= {c: self.best_split(hist[c], offsets) for c in (child, child + 1)}
            _, k = heapq.heappop(heap)
            taken[k] = left[k]
            for child in (left[k], left[k] + 1):
                order.append(child)
                if best[child][0] > 0:
                    heapq.heappush(heap, (-best[child][0], child))
        at = {k: i for i, k in enumerate(order)}
        first = slice(offsets[0], offsets[1])  # every row has one bin of the first feature
        sums = np.array([hist[k][:, first].sum(1) for k in order])
        tree = BinnedTree(np.array([best[k][1] for k in order]), np.array([best[k][2] - offsets[best[k][1]] for k in order]),
                          np.array([at[taken[k]] if k in taken else -1 for k in order]), -self.rate * sums[:, 1] / (sums[:, 0] + self.l2))
        return tree, np.array(order)

    def ended(self, losses: list[float]) -> bool:
        """Whether none of the last rounds was better than the one before them."""
        return self.patience is not None and len(losses) > self.patience and min(losses[-self.patience:]) >= losses[-self.patience - 1]

    def stops_early(self, rows: int) -> bool:
        return self.patience is not None and rows > 10_000

    def fit_local(self, codes: np.ndarray, y: np.ndarray, held: np.ndarray, offsets: np.ndarray) -> tuple[float, list[BinnedTree]]:
        rows = LocalRows(codes, int(offsets[-1]))
        learn, check = np.flatnonzero(~held), np.flatnonzero(held)
        start = float(y[learn].mean())
        guess, losses, trees = np.full(len(y), start), [], []
        for _ in range(self.iterations):
            if len(check):
                losses.append(float(((guess - y)[check] ** 2).sum()))
                if self.ended(losses):
                    break
            tree, nodes = self.grow(rows.start(learn, guess - y), rows.measure, offsets)
            for i in np.flatnonzero(tree.left < 0):
                guess[rows.held[nodes[i]]] += tree.value[i]
            guess[check] += tree.predict(codes[check] - offsets[:-1])
            trees.append(tree)
        return start, trees

    def fit_shared(self, rows: SharedRows, start: float, early: bool) -> tuple[float, list[BinnedTree]]:
        losses, trees = [], []
        for _ in range(self.iterations):
            if early:
                losses.append(rows.held_loss())
                if self.ended(losses):
                    break
            tree, _ = self.grow(rows.start(), rows.measure, rows.offsets)
            rows.add(tree)
            trees.append(tree)
        return start, trees


def bin_edges(rows: DataFrame, features: Sequence[str], group: str, bins: int = 255) -> dict[int, list[np.ndarray]]:
    """Of every group and feature: upper ends of all bins but the last, by quantiles (one aggregation)."""
    shares = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    got = rows.groupBy(group).agg(*(F.percentile_approx(F.col(f).cast("double"), shares, F.lit(20_000)).alias(f"q{k}") for k, f in enumerate(features)),
                                  *(F.max(F.col(f).cast("double")).alias(f"m{k}") for k, f in enumerate(features))).collect()
    out = {}
    for r in got:
        ends = [np.unique(np.array(r[f"q{k}"], float)) for k in range(len(features))]
        out[r[group]] = [e[e < r[f"m{k}"]] for k, e in enumerate(ends)]
    return out


def fit_boosting(rows: DataFrame, features: Sequence[str], target: str, group: str, folder: str, how: Boosting | None = None,
                 group_rows: int = GROUP_ROWS) -> dict[int, BoostedTrees]:
    """A boosted model for every value of the integer column ``group``.

    With more than 10,000 rows and ``patience``, a share of the rows is held out
    (by a hash of the row) and a fit ends early when their loss no longer falls.
    Features and targets must not be null.  ``folder``: shared, for blocks of large groups.
    """
    spark, features, how = rows.sparkSession, list(features), how or Boosting()
    sizes = {r[group]: r["count"] for r in rows.groupBy(group).count().collect()}
    edges = bin_edges(rows, features, group)
    models = {g: BoostedTrees(features, edges[g], 0.0, []) for g in sizes}
    offsets = {g: np.cumsum([0, *(len(e) + 1 for e in edges[g])]) for g in sizes}
    early = [g for g, n in sizes.items() if how.stops_early(n)]
    held = F.col("grp").isin(early) & (F.pmod(F.xxhash64(F.lit(how.seed), *features, "y"), F.lit(1000)) < int(1000 * how.held_share))
    data = rows.select(F.col(group).cast("int").alias("grp"), F.col(target).cast("double").alias("y"),
                       *(F.col(f).cast("double").alias(f) for f in features)).withColumn("held", held)
    codes_of = lambda g, x: (models[g].bins(x) + offsets[g][:-1]).astype(np.int16)
    small = [g for g, n in sizes.items() if n <= group_rows]

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        g = key[0].as_py()
        x = np.stack([np.asarray(table[f].combine_chunks()) for f in features], 1)
        y = np.asarray(table["y"].combine_chunks())
        order = np.lexsort((*x.T, y))  # an order of their own, so that a fit doesn't depend on how rows came
        held = np.asarray(table["held"].combine_chunks())
        start, trees = how.fit_local(codes_of(g, x[order]), y[order], held[order], offsets[g])
        first = BinnedTree(np.zeros(1, int), np.zeros(1, int), np.full(1, -1), np.array([start]))
        size = [len(t.left) for t in (first, *trees)]
        return pa.table({"grp": pa.array(np.full(sum(size), g), pa.int32()), "tree": np.repeat(np.arange(len(size)), size),
                         "node": np.concatenate([np.arange(n) for n in size]),
                         **{c: np.concatenate([getattr(t, c) for t in (first, *trees)]) for c in ("feature", "cut", "left", "value")}})

    if small:
        nodes = data.filter(F.col("grp").isin(small)).groupBy("grp").applyInArrow(
            fit, "grp int, tree long, node long, feature long, cut long, left long, value double").toArrow()
        nodes = nodes.sort_by([("grp", "ascending"), ("tree", "ascending"), ("node", "ascending")]).to_pandas()
        for (g, k), t in nodes.groupby(["grp", "tree"]):
            tree = BinnedTree(*(t[c].to_numpy() for c in ("feature", "cut", "left", "value")))
            if k:
                models[g].trees.append(tree)
            else:
                models[g].start = float(tree.value[0])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, x = np.asarray(batch.column(0)), _matrix(batch, features)
            y, held = np.asarray(batch.column(1)), np.asarray(batch.column(batch.num_columns - 1))
            for g in np.unique(group):
                at = group == g
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in (codes_of(g, x[at]), y[at], held[at]))],
                    ["grp", "codes", "target", "held"])

    large = [g for g in sizes if g not in small]
    if large:
        path = f"{folder.rstrip('/')}/binned"
        data.filter(F.col("grp").isin(large)).mapInArrow(blocks, "grp int, codes binary, target binary, held binary").write.partitionBy("grp").parquet(path)
    for g in large:
        models[g].start = data.filter((F.col("grp") == g) & ~F.col("held")).agg(F.avg("y")).first()[0]
        start = models[g].start

        def begin(batches: Iterator[pa.RecordBatch], start: float = start) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                guesses = [np.full(len(t) // 8, start).tobytes() for t in batch.column(1).to_pylist()]
                yield batch.append_column("prediction", pa.array(guesses, pa.binary()))

        mine = spark.read.parquet(path).filter(F.col("grp") == g).select("codes", "target", "held")
        table = mine.mapInArrow(begin, "codes binary, target binary, held binary, prediction binary")
        shared = SharedRows(table, int(offsets[g][-1]), offsets[g], f"{folder.rstrip('/')}/group-{g}")
        models[g].start, models[g].trees = how.fit_shared(shared, start, g in early)
    return models
