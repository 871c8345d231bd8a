"""Periodic runs of words through string synchronising sets (operator 12).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least max(12, 2 q) words that no neighbouring word extends
keeping period q.  All of them are found, exactly.

Scale by scale (t = 4, 8, 16, ...) a text's runs with periods 3 t - 1 to
6 t - 2 come from a set of synchronising positions:

* every stretch of t words has a hash; stretches inside a highly periodic region
  (a run of period at most t / 3) are left out;
* position i is selected if the least hash of the stretches that start at
  i, ..., i + t is that of the first or of the last of them.  The choice depends
  on the words i to i + 2 t - 1 alone (its context), and of any t neighbouring
  positions one is selected unless the 3 t - 1 words there are highly periodic;
* a run of such a period q holds two selected positions q apart with equal
  contexts, one in each of its first two periods, unless its first period lies
  in one highly periodic region.  So pairs of equal contexts at these distances
  propose periods.  Equal contexts are more than t / 3 apart, so a position has
  at most 18 partners;
* where the first period lies in a highly periodic region and its copy in
  another one of the same period that begins where the first ends, the distance
  of equal phases in the two regions proposes the periods;
* a proposal is a stretch of matching words; overlapping proposals of one period
  are joined, extended word by word to both sides and compared in full, so hashes
  decide nothing.  Should a context collide (64 bits), that period is searched in
  the whole text by comparison.

Periods up to 10, smaller than those of the first scale, are found by comparing
the text with itself shifted; they also are the first highly periodic regions.
Of stretches found with several periods the smallest period stays.

A task handles the texts of a slice at once, by length classes, so memory is
bounded by the slice (or one text).  Work is n log n.  Nothing is shuffled.

Cases.  Null and empty texts and texts of white space have no words and no runs.
Repeated rows are handled each.  All columns besides the text pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_words, documents, slices, spread, string_array, with_fields

MIN_LENGTH = 12
SMALL = 10  # periods found by shifting; the first scale begins above it
FIRST_SCALE = 4
_NONE = np.uint64(2**64 - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _joined(h: np.ndarray, length: int) -> np.ndarray:
    """Hashes of stretches of 2 * length words, from those of length words."""
    return _mix(h[:len(h) - length] * np.uint64(0x9E3779B97F4A7C15) + h[length:])


def _window_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of ``width`` values."""
    blocks = -(-len(h) // width)
    padded = np.full(blocks * width, _NONE)
    padded[:len(h)] = h
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(h) - width + 1
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _stretches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal stretches of true values: begins and ends."""
    turn = np.diff(np.concatenate([[0], equal.view(np.int8), [0]]))
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


class RunFinder:
    """Runs in one array of word codes, in which a code that occurs once ends every text."""

    def __init__(self, words: np.ndarray, longest: int) -> None:
        self.words, self.longest = words, longest
        self.found = np.empty((0, 3), np.int64)  # begin, end, period; periods that have a smaller one included

    def runs(self) -> np.ndarray:
        """begin, end and period of all runs, by begin and period."""
        self._small_periods()
        scale = FIRST_SCALE
        h = _mix(self.words.astype(np.uint64) + np.uint64(1))
        length = 1
        while length < scale:
            h, length = _joined(h, length), length * 2
        while 2 * (3 * scale - 1) <= self.longest:
            twice = _joined(h, scale)
            self._scale(scale, h, twice)
            h, scale = twice, scale * 2
        runs = self._distinct(self.found)
        return runs[runs[:, 1] - runs[:, 0] >= np.maximum(MIN_LENGTH, 2 * runs[:, 2])]

    @staticmethod
    def _distinct(runs: np.ndarray) -> np.ndarray:
        runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
        first = np.ones(len(runs), bool)
        first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
        runs = runs[first]
        return runs[np.lexsort((runs[:, 2], runs[:, 0]))]

    def _add(self, begins: np.ndarray, ends: np.ndarray, periods: np.ndarray) -> None:
        keep = ends - begins >= np.maximum(2 * periods, FIRST_SCALE)
        new = np.stack([begins[keep], ends[keep], periods[keep]], 1)
        self.found = self._distinct(np.concatenate([self.found, new]))

    def _shifted(self, period: int, a: int, b: int) -> None:
        """Runs of a period inside words a to b, by comparison."""
        part = self.words[a:b]
        begins, ends = _stretches(part[:len(part) - period] == part[period:]) if len(part) > period else (np.empty(0, int),) * 2
        self._add(begins + a, ends + a + period, np.full(len(begins), period))

    def _small_periods(self) -> None:
        for period in range(1, SMALL + 1):
            self._shifted(period, 0, len(self.words))

    def _scale(self, t: int, h: np.ndarray, twice: np.ndarray) -> None:
        low, high = 3 * t - 1, 6 * t - 2
        if len(twice) < t + 1:
            return
        regions = self.found[(3 * self.found[:, 2] <= t) & (self.found[:, 1] - self.found[:, 0] >= t)]
        edge = np.zeros(len(h) + 1, np.int32)
        np.add.at(edge, regions[:, 0], 1)
        np.add.at(edge, regions[:, 1] - t + 1, -1)
        ids = np.where(np.cumsum(edge[:-1]) > 0, _NONE, np.minimum(h, _NONE - np.uint64(1)))
        least = _window_min(ids, t + 1)
        sync = np.flatnonzero((least != _NONE) & ((ids[:len(least)] == least) | (ids[t:t + len(least)] == least)))
        sync = sync[sync < len(twice)]
        context = twice[sync]
        order = np.argsort(context, kind="stable")  # sync is ascending, so equal contexts are in text order
        sync, context = sync[order], context[order]
        places, distances = [], []
        apart = 1
        while apart < len(sync):
            near = (context[apart:] == context[:-apart]) & (sync[apart:] - sync[:-apart] <= high)
            if not near.any():
                break
            i = np.flatnonzero(near)
            d = sync[i + apart] - sync[i]
            places.append(sync[i[d >= low]])
            distances.append(d[d >= low])
            apart += 1
        if places:
            places, distances = np.concatenate(places), np.concatenate(distances)
            self._confirm(places, places + 2 * t, distances, t)
        self._confirm(*self._junctions(regions[regions[:, 1] - regions[:, 0] >= low], low, high), t)

    def _junctions(self, regions: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matches between two highly periodic regions of one period, the second of which begins where the first ends."""
        w = self.words
        out: list[tuple[int, int, int]] = []
        regions = regions[np.lexsort((regions[:, 0], regions[:, 2]))]
        next_to = np.flatnonzero((regions[1:, 2] == regions[:-1, 2]) & (regions[1:, 0] <= regions[:-1, 1]))
        for (b1, e1, p), (b2, e2, _) in zip(regions[next_to].tolist(), regions[next_to + 1].tolist()):
            phase = [x for x in range(e1 - 2 * p + 1, e1 - p + 1) if np.array_equal(w[x:x + p], w[b2:b2 + p])]
            if phase:
                first = low + (b2 - phase[0] - low) % p
                out += [(max(b1, b2 - q), min(e1, e2 - q), q) for q in range(first, min(high, e1 - b1, e2 - b2) + 1, p)]
        matches = np.array([m for m in out if m[0] < m[1]], np.int64).reshape(-1, 3)
        return matches[:, 0], matches[:, 1], matches[:, 2]

    def _confirm(self, a: np.ndarray, b: np.ndarray, period: np.ndarray, step: int) -> None:
        """Runs from proposals: words a to b - 1 seem to equal those ``period`` further on."""
        if not len(a):
            return
        order = np.lexsort((a, period))
        a, b, period = a[order], b[order], period[order]
        lift = period * (len(self.words) + 1)  # one running maximum for all periods; proposals that touch are joined
        reach = np.maximum.accumulate(b + lift) - lift
        new = np.ones(len(a), bool)
        new[1:] = (period[1:] != period[:-1]) | (a[1:] > reach[:-1])
        head = np.flatnonzero(new)
        last = np.append(head[1:], len(a)) - 1
        a, b, period = a[head], reach[last], period[head]
        b = b + self._extension(b, b + period, step, 1)
        a = a - self._extension(a - 1, a - 1 + period, step, -1)
        long = b - a >= period
        a, b, period = a[long], b[long], period[long]
        a, b, period = np.unique(np.stack([a, b, period], 1), axis=0).T
        lengths = b - a
        at = spread(a, lengths)
        wrong = self.words[at] != self.words[at + np.repeat(period, lengths)]
        bad = np.zeros(len(a), bool)
        if wrong.any():
            bad[np.unique(np.repeat(np.arange(len(a)), lengths)[wrong])] = True
        self._add(a[~bad], (b + period)[~bad], period[~bad])
        for i in np.flatnonzero(bad):  # a collision of hashes: compare the stretch and its surroundings instead
            self._shifted(int(period[i]), max(0, int(a[i]) - self.longest), min(len(self.words), int(b[i]) + self.longest))

    def _extension(self, i: np.ndarray, j: np.ndarray, step: int, way: int) -> np.ndarray:
        """How many words from i and j on (way 1) or back (way -1) are equal."""
        w, n = self.words, len(self.words)
        out = np.zeros(len(i), np.int64)
        active = np.arange(len(i))
        width = min(step, 64)
        while len(active):
            offset = out[active][:, None] + np.arange(width)
            x, y = i[active][:, None] + way * offset, j[active][:, None] + way * offset
            inside = (x >= 0) & (y < n)
            same = inside & (w[np.clip(x, 0, n - 1)] == w[np.clip(y, 0, n - 1)])
            matched = np.where(same.all(1), width, same.argmin(1))
            out[active] += matched
            active = active[matched == width]
            width = min(width * 2, max(64, (1 << 20) // max(1, len(active))))
        return out


def runs_of_texts(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts given as word codes one after another: the text of each run, and its begin, length and period there.

    Ordered by text, begin and period.
    """
    texts, found = [np.empty(0, np.int64)], [np.empty((0, 3), np.int64)]
    starts = np.cumsum(sizes) - sizes
    codes = codes.astype(np.int64)
    top = int(codes.max(initial=0)) + 1
    level = np.frexp(np.maximum(sizes, 1))[1]
    for k in np.unique(level[sizes >= MIN_LENGTH]):
        chosen = np.flatnonzero((level == k) & (sizes >= MIN_LENGTH))
        # every text and, behind it, a code of its own
        lengths = sizes[chosen] + 1
        ends = np.cumsum(lengths)
        words = np.empty(int(ends[-1]), np.int64)
        inside = np.ones(len(words), bool)
        inside[ends - 1] = False
        words[inside] = codes[spread(starts[chosen], sizes[chosen])]
        words[ends - 1] = top + np.arange(len(chosen))
        runs = RunFinder(words, int(sizes[chosen].max())).runs()
        of = np.searchsorted(ends, runs[:, 0], side="right")
        texts.append(chosen[of])
        found.append(np.stack([runs[:, 0] - (ends - lengths)[of], runs[:, 1] - runs[:, 0], runs[:, 2]], 1))
    text, runs = np.concatenate(texts), np.concatenate(found)
    order = np.lexsort((runs[:, 2], runs[:, 0], text))
    return text[order], runs[order]


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """All other columns, and of each text: n_words, ``runs`` (start word, length, period; by start) and ``collapsed``.

    ``collapsed``: the words, joined by one space, without those that a run
    contains after its first period.
    """
    others = [f for f in docs.schema.fields if f.name != text]
    chosen = docs.select(F.col(f"`{text}`").alias(text), *(F.col(f"`{f.name}`") for f in others))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words, sizes = ascii_words(string_array(batch.column(0)))
            coded = words.dictionary_encode()
            of, runs = runs_of_texts(np.asarray(coded.indices), sizes)
            begins = np.cumsum(sizes) - sizes
            edge = np.zeros(len(words) + 1, np.int32)
            at = begins[of] + runs[:, 0]
            np.add.at(edge, at + runs[:, 2], 1)
            np.add.at(edge, at + runs[:, 1], -1)
            stay = np.cumsum(edge[:-1]) == 0
            bounds = np.concatenate([[0], np.cumsum(stay)])[np.append(begins, len(words))]
            left = words.filter(pa.array(stay))
            collapsed = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), left), " ")
            records = pa.StructArray.from_arrays([pa.array(runs[:, i].copy()) for i in range(3)], ["start", "length", "period"])
            cuts = np.searchsorted(of, np.arange(len(sizes) + 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sizes.astype(np.int64)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), records), collapsed.cast(pa.string())],
                [*batch.schema.names[1:], "n_words", "runs", "collapsed"])

    added = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return chosen.mapInArrow(run, with_fields(others, added))


def planted(doc_id: Column, text: Column) -> Column:
    """The text of the contract: where crc32(doc_id) % 10 = 0, its words from a place on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(r"([^ \t-\r]+)"), F.lit(1))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice(words, a + 1, p)
    whole = F.flatten(F.array_repeat(block, F.floor((n - a) / p).cast("int")))
    joined = F.array_join(F.concat(F.slice(words, F.lit(1), a), whole, F.slice(words, a + 1, (n - a) % p)), " ")
    return F.when(h % 10 == 0, F.when(n > 0, joined).otherwise(text)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", planted(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs(docs)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    start, length, period = (-longest["s"]), longest["length"], (-longest["p"])
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
