"""Embedding near-duplicates by E8 lattice hashing (operator 13).

Vectors of one label with a cosine of at least the threshold are linked; linked
vectors form components.

1. Equal vectors of a label become one class with a multiplicity.
2. Tables: in each table a class's unit vector is projected to ``blocks`` times 8
   dimensions by random normal directions and every 8 are decoded to the nearest
   point of the E8 lattice; the points (with table, label and length) are its
   home cell.  It also probes cells of neighbouring lattice points: of each block
   the ``probes`` among the 240 shortest lattice vectors that lie closest to where
   the projection is off its point.
3. A pair meets in a table where one is at home in a cell and the other is at home
   there too or probes it.  ``hit_odds`` simulates how often a pair at the threshold
   meets, and the number of tables follows from the target recall.
4. In a cell all meeting pairs are compared by cosine in double precision.  A pair
   that meets several times counts the first time only, which both rows can tell
   from the cells they carry, so that links are counted without writing pairs: a
   task emits one row a class, with its number of links and the least class it
   is connected with there.
5. Components by hooking and pointer jumping over those connections.

Scale.  Cells that only one class visits are dropped before vectors are sent.
Large cells are dealt in blocks of ``limit`` at home against ``limit`` of all, so
no task holds a cell; a cell of c costs c * c / limit rows, as all its pairs must
be compared to count links.  The number of blocks grows with the logarithm of the
number of vectors (25,000 cells a block), so chance meetings per vector stay bounded.

Cases.  A vector that is null, empty, all zero, or holds null or non-finite
components, and any with a null label, is linked with nothing and its own
component.  Vectors of different lengths aren't compared.  Equal vectors are linked
(cosine 1).  Rows that repeat a vec_id are vectors of their own.  Rows without
vec_id are linked and counted, but name no component unless all its rows lack one.
An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import components, scratch, spread, store, table

#: The 240 shortest vectors of E8: two coordinates of +-1, or all of +-1/2 with an even number of minus signs.
SHORTEST = np.array(
    [[s if k == i else t if k == j else 0 for k in range(8)] for i, j in combinations(range(8), 2) for s, t in product((1, -1), repeat=2)]
    + [v for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0])
CELLS = 25_000  # odds that two unrelated vectors share a cell of one block, at width 1
PAIRS = 1 << 17  # compared at once


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The E8 lattice point nearest to each row of 8 numbers."""

    def even(y: np.ndarray) -> np.ndarray:  # nearest integer point with an even sum
        point = np.rint(y)
        off = y - point
        odd = np.flatnonzero(point.sum(1) % 2 != 0)
        worst = np.abs(off[odd]).argmax(1)
        point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
        return point

    whole, half = even(x), even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def neighbours(x: np.ndarray, point: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` lattice points around ``point`` that are nearest to x (rows x probes x 8)."""
    along = (x - point) @ SHORTEST.T
    nearest = np.argpartition(-along, probes - 1, axis=1)[:, :probes]
    return point[:, None, :] + SHORTEST[nearest]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _point_hash(points: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Hash of lattice points (last axis) in a block of dimensions."""
    doubled = np.rint(2 * points).astype(np.int64).view(np.uint64)
    h = np.broadcast_to(block.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15), doubled.shape[:-1])
    for k in range(8):
        h = _mix(h * np.uint64(0xD1342543DE82EF95) + doubled[..., k])
    return h


class LatticeTables:
    """Home cells and probed cells of vectors in ``tables`` tables."""

    def __init__(self, tables: int, blocks: int, probes: int, width: float, seed: int = 13) -> None:
        self.tables, self.blocks, self.probes, self.width, self.seed = tables, blocks, probes, width, seed

    def cells(self, unit: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """home (rows x tables) and probed (rows x tables x probed cells) cells as 64-bit hashes.

        ``salt``: a number a row; rows of different salt share no cell.
        """
        n, dim = unit.shape
        rng = np.random.default_rng([self.seed, dim])
        directions = rng.normal(size=(dim, self.tables * self.blocks * 8)) / self.width
        x = (unit @ directions).reshape(-1, 8)
        point = nearest_e8(x)
        block = np.tile(np.arange(self.tables * self.blocks), n)
        own = _point_hash(point, block).reshape(n, self.tables, self.blocks)
        near = _point_hash(neighbours(x, point, self.probes), block[:, None]).reshape(n, self.tables, self.blocks, self.probes)
        total = own.sum(2) + _mix(salt.astype(np.uint64) + np.uint64(1))[:, None] + np.arange(self.tables, dtype=np.uint64)
        probed = total[:, :, None, None] - own[..., None] + near
        return _mix(total), _mix(probed.reshape(n, self.tables, self.blocks * self.probes))


def hit_odds(threshold: float, blocks: int, probes: int, width: float, samples: int = 20_000) -> float:
    """How often a pair with a cosine of ``threshold`` meets in one table (simulated)."""
    rng = np.random.default_rng(8)
    first = rng.normal(size=(samples * blocks, 8))
    other = threshold * first + math.sqrt(1 - threshold**2) * rng.normal(size=first.shape)
    a, b = nearest_e8(first / width), nearest_e8(other / width)
    same = (a == b).all(1).reshape(samples, blocks)
    ahead = (neighbours(first / width, a, probes) == b[:, None]).all(2).any(1).reshape(samples, blocks)
    back = (neighbours(other / width, b, probes) == a[:, None]).all(2).any(1).reshape(samples, blocks)
    apart = (~same).sum(1)
    return float(((apart == 0) | (apart == 1) & ((ahead | back) & ~same).any(1)).mean())


def tables_for(threshold: float, recall: float, blocks: int, probes: int, width: float) -> int:
    """Independent tables so that a pair at the threshold meets in one of them."""
    return math.ceil(math.log(1 - recall) / math.log(1 - hit_odds(threshold, blocks, probes, width)))


class LatticeJoin:
    """One run over (vec_id, embedding, label); intermediate tables lie in ``folder``, a shared folder."""

    def __init__(self, vectors: DataFrame, folder: str, threshold: float = 0.98, recall: float = 0.9999, probes: int = 4,
                 width: float = 1.0, blocks: int | None = None, limit: int = 512) -> None:
        self.folder, self.threshold, self.recall, self.limit = folder, threshold, recall, limit
        self.probes, self.width, self.blocks = probes, width, blocks
        self.vectors = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return store(df, f"{self.folder}/{name}")

    # -- 1. classes

    def digests(self) -> DataFrame:
        """vec_id, digest (null: linked with nothing), label and vector (bytes of the unit vector's double components)."""
        fit = (F.col("label").isNotNull() & F.col("embedding").isNotNull()
               & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0))
        kind = dict(self.vectors.dtypes)["vec_id"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                digests, vectors = [], []
                for values, label in zip(batch.column(1), batch.column(2).to_pylist()):
                    if not values.is_valid:
                        digests.append(None)
                        vectors.append(None)
                        continue
                    v = np.asarray(values.values) + 0.0  # no minus zero
                    digests.append(xxhash.xxh3_128_digest(v.tobytes() + str(label).encode()))
                    v = v / np.abs(v).max()  # squares neither overflow nor vanish
                    vectors.append((v / math.sqrt(float(v @ v))).tobytes())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), batch.column(2), pa.array(vectors, pa.binary())],
                                                 ["vec_id", "digest", "label", "vector"])

        chosen = self.vectors.select("vec_id", F.when(fit, F.col("embedding")).alias("embedding"), F.col("label").cast("string"))
        return chosen.mapInArrow(run, f"vec_id {kind}, digest binary, label string, vector binary")

    # -- 2. cells

    def cells(self, classes: DataFrame, tables: LatticeTables) -> DataFrame:
        """classes with their home and probed cells, as bytes of 64-bit numbers."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
                rows = batch.column(batch.schema.get_field_index("vector")).to_pylist()
                labels = batch.column(batch.schema.get_field_index("label")).to_pylist()
                home, probed = [b""] * len(rows), [b""] * len(rows)
                sizes = np.array([len(r) // 8 for r in rows])
                for dim in np.unique(sizes):
                    at = np.flatnonzero(sizes == dim)
                    salt = np.array([xxhash.xxh3_64_intdigest(labels[i], seed=int(dim)) for i in at], np.uint64)
                    own, near = tables.cells(np.frombuffer(b"".join(rows[i] for i in at)).reshape(len(at), dim), salt)
                    for k, i in enumerate(at):
                        home[i], probed[i] = own[k].tobytes(), near[k].tobytes()
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.binary()), pa.array(probed, pa.binary())],
                                                 [*batch.schema.names, "home", "probed"])

        return classes.mapInArrow(run, f"{', '.join(f'{n} {t}' for n, t in classes.dtypes)}, home binary, probed binary")

    def visits(self, celled: DataFrame) -> DataFrame:
        """cell, cls, place (table number) and at_home of all visits to cells where a pair can meet, with the cell's sizes."""
        tables, near = self.tables.tables, self.tables.blocks * self.tables.probes

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n = batch.num_rows
                own = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(n, tables, 1)
                probed = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.int64).reshape(n, tables, near)
                cells = np.concatenate([own, probed], 2)
                shape = cells.shape
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.ravel()), pa.array(np.repeat(np.asarray(batch.column(0)), tables * (1 + near))),
                     pa.array(np.broadcast_to(np.arange(tables, dtype=np.int32)[:, None], shape).ravel()),
                     pa.array(np.broadcast_to(np.arange(1 + near) == 0, shape).ravel())], ["cell", "cls", "place", "at_home"])

        visits = self.store(celled.select("cls", "home", "probed").mapInArrow(run, "cell long, cls long, place int, at_home boolean"), "visits")
        sizes = (visits.groupBy("cell").agg(F.count("*").alias("n"), F.sum(F.col("at_home").cast("int")).alias("n_home"))
                 .where("n > 1 and n_home > 0"))
        return visits.join(sizes, "cell")

    # -- 4. comparison

    def compare(self, visits: DataFrame, celled: DataFrame) -> DataFrame:
        """cls, links (of vectors of other classes) and least (a class connected with it): several rows a class."""
        limit = F.lit(self.limit)
        blocks_home, blocks_all = (F.ceil(F.col(c) / limit).cast("int") for c in ("n_home", "n"))
        own = lambda n: F.pmod(F.xxhash64("cls", "cell"), n).cast("int")
        small = (F.col("n") <= limit)
        # Small cells: one group, in which rows at home meet all.  Large cells: each block at home meets each block of all.
        left = visits.where(~small & F.col("at_home")).select(
            "cell", "place", "cls", "at_home", own(blocks_home).alias("i"), F.explode(F.sequence(F.lit(0), blocks_all - 1)).alias("j"), F.lit(1).alias("side"))
        right = visits.select(
            "cell", "place", "cls", "at_home", F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks_home - 1))).alias("i"),
            F.when(small, 0).otherwise(own(blocks_all)).alias("j"), F.when(small, 0).otherwise(2).alias("side"))
        grouped = left.union(right).join(celled.select("cls", "copies", "vector", "home", "probed"), "cls")
        tables, threshold = self.tables, self.threshold

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rest: pa.Table | None = None  # the last group, which may go on
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                rows = rows if rest is None else pa.concat_tables([rest, rows])
                cut = int(_group_starts(rows)[-1]) if rows.num_rows else 0
                rest = rows.slice(cut)
                yield from _met(rows.slice(0, cut), tables, threshold)
            if rest is not None:
                yield from _met(rest, tables, threshold)

        dealt = grouped.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
        return dealt.mapInArrow(run, "cls long, links long, least long")

    def run(self) -> DataFrame:
        """vec_id, n_links, component_id and kept of every row."""
        rows = self.store(self.digests(), "rows")
        classes = self.store(rows.where("digest is not null").groupBy("digest").agg(
            F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
            .withColumn("cls", F.monotonically_increasing_id()), "classes")
        n = classes.count()
        blocks = self.blocks or max(1, math.ceil(math.log(max(2, n / 64), CELLS)))
        self.tables = LatticeTables(tables_for(self.threshold, self.recall, blocks, self.probes, self.width), blocks, self.probes, self.width)
        celled = self.store(self.cells(classes.select("cls", "copies", "label", "vector"), self.tables), "celled")
        found = self.store(self.compare(self.visits(celled), celled), "found")
        links = found.groupBy("cls").agg(F.sum("links").alias("links"))
        member = components(found.where("cls != least").select(F.col("cls").alias("a"), F.col("least").alias("b")), f"{self.folder}/components")
        named = classes.select("cls", "digest", "first_id", "copies").join(links, "cls", "left").join(
            member.withColumnRenamed("rep", "cls"), "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        named = self.store(named, "named")
        names = named.groupBy("comp").agg(F.min("first_id").alias("component_id"))
        result = named.join(names, "comp").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        linked = rows.where("digest is not null").select("vec_id", "digest").join(result, "digest").select("vec_id", "n_links", "component_id")
        alone = rows.where("digest is null").select("vec_id", F.lit(0).cast("long"), F.col("vec_id"))
        return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _group_starts(rows: pa.Table) -> np.ndarray:
    key = np.stack([np.asarray(rows[c].combine_chunks(), np.int64) for c in ("cell", "i", "j")], 1)
    return np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))


def _met(rows: pa.Table, tables: LatticeTables, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links inside whole groups (rows in order of their groups): a row for each class that has one."""
    if not rows.num_rows:
        return
    starts = _group_starts(rows)
    sizes = np.diff(np.append(starts, rows.num_rows))
    group = np.repeat(np.arange(len(starts)), sizes)
    column = lambda c: rows[c].combine_chunks()
    cls, side, place, copies = (np.asarray(column(c)).astype(np.int64) for c in ("cls", "side", "place", "copies"))
    at_home = np.asarray(column("at_home"))
    vectors, home, probed = (column(c).to_pylist() for c in ("vector", "home", "probed"))
    dims = np.array([len(v) for v in vectors])
    query = np.flatnonzero(at_home & (side != 2))
    links, close = np.zeros(len(cls), np.int64), [(query[:0], query[:0])]
    # queries are taken so many at a time that their pairs fit
    for part in np.split(query, np.flatnonzero(np.diff(np.cumsum(sizes[group[query]]) // PAIRS)) + 1):
        left = np.repeat(part, sizes[group[part]])
        right = spread(starts[group[part]], sizes[group[part]])
        fit = (side[right] != 1) & (cls[left] != cls[right]) & (dims[left] == dims[right]) & (~at_home[right] | (cls[left] < cls[right]))
        left, right = left[fit], right[fit]
        for dim in np.unique(dims[left]):
            i, j = left[dims[left] == dim], right[dims[left] == dim]
            used, of = np.unique(np.concatenate([i, j]), return_inverse=True)
            unit = np.frombuffer(b"".join(vectors[k] for k in used)).reshape(len(used), -1)
            linked = np.einsum("ij,ij->i", unit[of[:len(i)]], unit[of[len(i):]]) >= threshold
            i, j = i[linked], j[linked]
            first = _first_meeting(i, j, place, at_home, cls, home, probed, tables)
            np.add.at(links, i[first], copies[j[first]])
            np.add.at(links, j[first], copies[i[first]])
            close.append((i, j))
    i, j = (np.concatenate(x) for x in zip(*close))
    least = cls.copy()  # becomes the least class of each component in its group
    while True:
        low = np.minimum(least[i], least[j])
        if (least[i] == low).all() and (least[j] == low).all():
            break
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
    out = np.flatnonzero((links > 0) | (least != cls))
    if len(out):
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (cls, links, least)], ["cls", "links", "least"])


def _first_meeting(i: np.ndarray, j: np.ndarray, place: np.ndarray, at_home: np.ndarray, cls: np.ndarray,
                   home: list[bytes], probed: list[bytes], tables: LatticeTables) -> np.ndarray:
    """Of pairs (i at home, j there) that meet in table ``place``: whether they didn't meet before."""
    if not len(i):
        return np.zeros(0, bool)
    used, inverse = np.unique(np.concatenate([i, j]), return_inverse=True)
    own = np.frombuffer(b"".join(home[k] for k in used), np.int64).reshape(len(used), tables.tables)
    near = np.frombuffer(b"".join(probed[k] for k in used), np.int64).reshape(len(used), tables.tables, -1)
    a, b = inverse[:len(i)], inverse[len(i):]
    at = place[i]
    earlier = np.zeros(len(i), bool)
    twice = earlier.copy()
    for t in range(tables.tables):
        ahead = (near[a, t] == own[b, t][:, None]).any(1)  # i probes j's home
        back = (near[b, t] == own[a, t][:, None]).any(1)
        earlier |= (t < at) & ((own[a, t] == own[b, t]) | ahead | back)
        # in one table a pair can meet twice, each in the other's home: it counts in that of the lesser class
        twice |= (t == at) & ~at_home[j] & ahead & (cls[i] > cls[j])
    return ~earlier & ~twice


def embedding_near_duplicates(vectors: DataFrame, folder: str, **options: object) -> DataFrame:
    return LatticeJoin(vectors, folder, **options).run()


def op13_lattice_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), scratch(spark, "lattice-join"))
