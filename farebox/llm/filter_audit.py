"""Filter interaction audit by truth-table survival words (operator 11).

A document fails some of n filters.  Its survival word has one bit for each
subset of the filters: bit S is set if the document fails no filter of S.  With
five filters that is one 32-bit word.  How many documents survive each subset
is then a positional popcount of the words, done with carry-save adders: words
are held as bit planes of weight 1, 2, 4, ...; three words of a plane become one
word of that plane (their sum) and one of the next (their carry).

Everything in the report is a difference of such counts: with filters P before
it, filter f keeps N[P+f], removes N[P] - N[P+f], and so on, in any order.

Scale.  Texts are read once, by tasks that keep 60 bytes a document.  Equal
(text, doc_id, part) rows are counted before any join and enter the popcount
with their number, a bit at a time at the plane of that weight, so repeated rows
make no hot key.  "Identical to a smaller doc_id's text" is a minimum by text
digest, joined back on (digest, doc_id), so a group of copies is spread by
doc_id.  A task's planes hold a few words for each (part, label) pair, and are
sent off early if there are many pairs.

Cases.  Null text counts as empty; null part as ''.  A row without doc_id has no
label, no smaller doc_id, and isn't one itself.  Several label rows of a doc_id:
quality (toxic) is 1 if any of them says 1.  Repeated rows count each.  Equal
doc_ids are no smaller ids of one another.  No document: no part, no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import ascii_words, per_text, scratch, slices, store, string_array, table

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
#: Survival word of every set of failed filters (bit f of the index: filter f fails).
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not fails & s) for fails in range(SUBSETS)], np.uint32)
MAX_PAIRS = 4096  # (part, label) pairs whose planes a task holds at once

_UPPER, _SYMBOL = np.zeros(256, bool), np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL[list(b"#$%&*|")] = True


class PositionalCounter:
    """How often each bit position is set in the words added so far."""

    def __init__(self) -> None:
        self.planes: list[np.ndarray] = []  # at most two words a plane after add()

    def add(self, words: np.ndarray, plane: int = 0) -> None:
        """Adds ``words``, each as often as the weight of ``plane``."""
        while len(words):
            while len(self.planes) <= plane:
                self.planes.append(np.empty(0, np.uint32))
            words = np.concatenate([self.planes[plane], words])
            carries = [np.empty(0, np.uint32)]
            while len(words) > 2:
                n = len(words) // 3
                a, b, c = words[:n], words[n:2 * n], words[2 * n:3 * n]
                either = a ^ b
                carries.append((a & b) | (either & c))
                words = np.concatenate([either ^ c, words[3 * n:]])
            self.planes[plane] = words
            words, plane = np.concatenate(carries), plane + 1

    def add_times(self, words: np.ndarray, times: np.ndarray) -> None:
        """Adds each word as often as ``times`` says: a bit of the number at a time."""
        for plane in range(int(times.max(initial=0)).bit_length()):
            self.add(words[(times >> plane) & 1 == 1], plane)

    def counts(self) -> np.ndarray:
        out = np.zeros(32, np.int64)
        for weight, words in enumerate(self.planes):
            for word in words.tolist():
                out += [(word >> bit & 1) << weight for bit in range(32)]
        return out


def text_failures(texts: pa.Array) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    words, n_words = ascii_words(texts)
    coded = words.dictionary_encode()
    of = np.repeat(np.arange(len(texts), dtype=np.int64), n_words)
    pairs = np.unique(of * max(1, len(coded.dictionary)) + np.asarray(coded.indices, np.int64))
    distinct = np.bincount(pairs // max(1, len(coded.dictionary)), minlength=len(texts))
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    first, total = _first_byte(texts), int(sizes.sum())
    data = np.frombuffer(texts.buffers()[2], np.uint8)[first:first + total] if total else np.empty(0, np.uint8)
    upper = per_text(_UPPER[data].astype(np.int64), sizes)
    points = per_text(((data & 0xC0) != 0x80).astype(np.int64), sizes)
    symbols = per_text(_SYMBOL[data].astype(np.int64), sizes)
    return ((n_words < 200) | (100 * distinct < 50 * n_words) << 1 | (100 * upper > 2 * points) << 2 | (symbols > 0) << 3).astype(np.int32)


def _first_byte(texts: pa.Array) -> int:
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    return int(np.frombuffer(texts.buffers()[1], width)[texts.offset]) if len(texts) else 0


def document_facts(docs: DataFrame, text: str, part: str) -> DataFrame:
    """doc_id, part, fails (filters A to D) and digest of every document."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = string_array(batch.column(1))
            digests = [hashlib.sha256(x).digest() for x in texts.cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(text_failures(texts)), pa.array(digests, pa.binary())],
                                             ["doc_id", "part", "fails", "digest"])

    chosen = docs.select("doc_id", F.col(text).alias("text"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    return chosen.mapInArrow(run, f"doc_id {kind}, part string, fails int, digest binary")


def labelled_failures(docs: DataFrame, labels: DataFrame, folder: str, text: str = "text", part: str = "source") -> DataFrame:
    """part, fails (all filters, as bits), label (1: quality, 2: toxic) and n: how many rows of a document are alike."""
    facts = store(document_facts(docs, text, part).groupBy("digest", "doc_id", "part", "fails").agg(F.count("*").alias("n")), f"{folder}/facts")
    first = facts.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg((F.max((F.col("quality") == 1).cast("int")).alias("q")), F.max((F.col("toxic") == 1).cast("int")).alias("t"))
             .select("doc_id", (F.coalesce("q", F.lit(0)) + 2 * F.coalesce("t", F.lit(0))).alias("label")))
    known = facts.where("doc_id is not null").join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    known = known.select("part", "n", F.coalesce("label", F.lit(0)).alias("label"),
                         (F.col("fails") + F.when(F.col("is_first"), 0).otherwise(1 << FILTERS.index("E"))).alias("fails"))
    return known.union(facts.where("doc_id is null").select("part", "n", F.lit(0), "fails"))


def survivors(failures: DataFrame) -> DataFrame:
    """part, subset (bits of filters), kept, good and toxic: documents that survive the subset's filters, of each label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], PositionalCounter] = {}

        def send() -> pa.RecordBatch:
            keys = list(held)
            counts = np.concatenate([held[k].counts() for k in keys])
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys for _ in range(SUBSETS)], pa.string()), pa.array(np.repeat([k[1] for k in keys], SUBSETS).astype(np.int32)),
                 pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(keys))), pa.array(counts)], ["part", "label", "subset", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode()
            group = np.asarray(parts.indices, np.int64) * 4 + np.asarray(batch.column(2))
            words, times = WORDS[np.asarray(batch.column(3))], np.asarray(batch.column(1))
            order = np.argsort(group, kind="stable")
            cuts = np.flatnonzero(np.diff(group[order])) + 1
            for rows in np.split(order, cuts):
                key = (parts.dictionary[int(group[rows[0]] // 4)].as_py(), int(group[rows[0]] % 4))
                held.setdefault(key, PositionalCounter()).add_times(words[rows], times[rows])
            if len(held) > MAX_PAIRS:
                yield send()
        if held:
            yield send()

    counted = failures.select("part", "n", "label", "fails").mapInArrow(run, "part string, label int, subset int, n long")
    of = lambda bit: F.sum(F.when(F.col("label").bitwiseAND(bit) > 0, F.col("n")).otherwise(0))
    return counted.groupBy("part", "subset").agg(F.sum("n").alias("kept"), of(1).alias("good"), of(2).alias("toxic"))


def order_report(subsets: DataFrame) -> DataFrame:
    """One row per part, filter order and step, from the survivors of every subset (32 rows a part)."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(f"named_struct('filter_order', '{order}', 'step', {step}, 'before', {before}, 'after', {before | bit[f]}, 'filter', {bit[f]})")
            before |= bit[f]
    every_step = F.expr(f"inline(array({', '.join(steps)}))")
    row = F.struct("subset", F.struct("kept", "good", "toxic"))
    by_part = subsets.groupBy("part").agg(F.map_from_entries(F.collect_list(row)).alias("n"))
    rows = by_part.select("part", "n", every_step)
    at = lambda key: F.element_at("n", key)
    after, before = at(F.col("after")), at(F.col("before"))
    others = F.lit(ALL) - F.col("filter")
    removed = before["kept"] - after["kept"]
    report = rows.select(
        "part", "filter_order", "step", "filter", after["kept"].alias("kept"), removed.alias("removed"),
        (at(F.lit(0))["kept"] - at(F.col("filter"))["kept"] - removed).alias("redundant"),
        (at(others)["kept"] - at(F.lit(ALL))["kept"]).alias("unique_fails"),
        (before["good"] - after["good"]).alias("good_lost"), (before["toxic"] - after["toxic"]).alias("toxic_lost"))
    return report.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")


def filter_audit(docs: DataFrame, labels: DataFrame, folder: str, text: str = "text", part: str = "source") -> DataFrame:
    """What each filter keeps and removes at each step of each order, by part.  ``folder``: shared, for one table of facts."""
    return order_report(survivors(labelled_failures(docs, labels, folder, text, part)))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return filter_audit(docs, table(spark, sf_dir, "labels"), scratch(spark, "filter-audit"))


ORACLE = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), smallest AS (
  SELECT body, min(doc_id) AS first_id FROM base GROUP BY body
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         [len(words) < 200,
          100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 2 * length(body),
          regexp_matches(body, '[#$%&*|]'),
          coalesce(base.doc_id > first_id, false)] AS fails
  FROM base JOIN smallest USING (body) LEFT JOIN marks m ON m.doc_id = base.doc_id
), patterns AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) a, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) b,
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) c, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) d,
       (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l) e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, ascii(substr(filter_order, step, 1)) - 64 AS f,
         [ascii(substr(filter_order, i, 1)) - 64 FOR i IN range(1, step)] AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step) s
), judged AS (
  SELECT p.part, s.filter_order, s.step, s.f, p.n, p.good, p.toxic, p.fails[s.f] AS fails_here,
         len([i FOR i IN s.before IF p.fails[i]]) > 0 AS gone,
         len([x FOR x IN p.fails IF x]) = 1 AS fails_one
  FROM patterns p, steps s
), counted AS (
  SELECT part, filter_order, step, f,
         sum(CASE WHEN NOT gone AND NOT fails_here THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails_here THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails_here THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails_here AND fails_one THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails_here THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails_here THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
