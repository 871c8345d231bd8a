"""Token-id store in Re-Pair grammar compression (operator 4).

Token ids are written in ascending document order as shards of bounded size.  A
shard is one row of a Parquet table: the ids of its documents, where its tokens
start, and a binary payload with a grammar of its own.  Re-Pair replaces
frequent pairs of neighbouring symbols by new symbols, round after round; the
rules of a round only use symbols of earlier rounds, so a round is undone in
one vectorised pass.  No rule spans two documents, and every symbol's expansion
length is stored, so a document, or some tokens of it, is decoded without the
rest.

Documents are range-partitioned and sorted by id; each task writes the shards
of its range.  Parquet's commit protocol makes the write safe against lost
executors, on any file system that Spark can write to.

Payload (little-endian): magic 'RPG1'; six 32-bit numbers (documents, alphabet
size, rounds, rules, symbols, bytes of a symbol); the alphabet; the first rule
of each round; left and right sides of the rules; expansion lengths of the
rules; the documents' first symbols; the symbols.

Cases.  Null text counts as empty: a document of the end id alone.  Null ids
come first.  Rows that repeat are stored each for itself, one after another.  A
document longer than a shard is a shard by itself.  An empty table gives an
empty store.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import ByteBPE
from .common import SLICE_BYTES, documents, scratch, slices
from .packing import MAX_CHUNKS, library_coder

MAGIC = b"RPG1"
HEAD = struct.Struct("<4s6I")


def repair(ids: np.ndarray, sizes: np.ndarray, min_count: int = 6, max_symbols: int = 65_535, min_gain: float = 0.02) -> bytes:
    """The payload of documents whose ids follow one another; ``sizes``: ids of each document.

    A round counts all pairs, ranks those that occur ``min_count`` times by
    frequency, and replaces each occurrence that no neighbouring occurrence of a
    more frequent pair overlaps.  It ends when a round saves less than
    ``min_gain`` of the symbols or symbols run out.
    """
    counts = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    alphabet = np.flatnonzero(counts).astype(np.uint32)
    dense = np.cumsum(counts > 0) - 1
    seq = dense[ids].astype(np.uint32) if len(ids) else np.zeros(0, np.uint32)
    final = np.zeros(len(seq), bool)  # symbols that end a document
    final[np.cumsum(sizes) - 1] = True
    symbols, firsts, left, right = len(alphabet), [], [], []
    max_symbols = min(max_symbols, 65_535)
    lengths = [np.ones(symbols, np.uint32)]
    while len(seq) > 1 and symbols < max_symbols:
        at = np.flatnonzero(~final[:-1])
        key = seq[at] << np.uint32(16) | seq[at + 1]  # symbols fit 16 bits; so a pair sorts as 32
        order = np.sort(key.astype(np.uint64) << np.uint64(32) | at.astype(np.uint64))  # far faster than argsort
        ranked, order = (order >> np.uint64(32)).astype(np.uint32), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
        edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
        runs = np.diff(np.concatenate([edges, [len(ranked)]]))
        often = np.flatnonzero(runs >= min_count)
        often = often[np.argsort(-runs[often], kind="stable")][:max_symbols - symbols]
        if not len(often):
            break
        priority = np.zeros(len(runs), np.int32)
        priority[often] = np.arange(len(often), 0, -1)
        here = np.zeros(len(seq) + 1, np.int32)
        here[order] = np.repeat(priority, runs)
        now, before, after = here[:-1], np.concatenate([[0], here[:-2]]), here[1:]
        take = np.flatnonzero((now > before) & (now >= after))
        rule = len(often) - now[take]
        uses = np.bincount(rule, minlength=len(often))
        good = uses >= 4  # a rule costs three numbers
        take = take[good[rule]]
        if len(take) <= min_gain * len(seq):
            break
        kept = often[good]
        number = np.cumsum(good) - 1
        pair = ranked[edges[kept]]
        firsts.append(symbols)
        left.append(pair >> np.uint32(16))
        right.append(pair & np.uint32(0xFFFF))
        known = np.concatenate(lengths)
        lengths.append(known[left[-1]] + known[right[-1]])
        seq[take] = symbols + number[len(often) - now[take]]
        final[take] = final[take + 1]
        stay = np.ones(len(seq), bool)
        stay[take + 1] = False
        seq, final = seq[stay], final[stay]
        symbols += len(kept)
    width = 2 if symbols <= 65_536 else 4
    starts = np.concatenate([[0], np.flatnonzero(final) + 1])[:len(sizes)].astype(np.uint32)
    none = [np.zeros(0, np.uint32)]
    parts = [alphabet, np.array(firsts, np.uint32), *(left or none), *(right or none), *(lengths[1:] or none), starts]
    head = HEAD.pack(MAGIC, len(sizes), len(alphabet), len(firsts), symbols - len(alphabet), len(seq), width)
    return b"".join([head, *(p.astype("<u4").tobytes() for p in parts), seq.astype(f"<u{width}").tobytes()])


class Shard:
    """Reads a payload."""

    def __init__(self, payload: bytes) -> None:
        magic, self.documents, n, rounds, rules, size, width = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = HEAD.size

        def numbers(count: int, kind: str = "<u4") -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.alphabet, self.firsts = numbers(n), numbers(rounds)
        self.left, self.right, long = numbers(rules), numbers(rules), numbers(rules)
        self.lengths = np.concatenate([np.ones(n, np.uint32), long])
        self.starts = np.concatenate([numbers(self.documents).astype(np.int64), [size]])
        self.symbols = numbers(size, f"<u{width}")

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that symbols stand for."""
        seq, n = symbols.astype(np.uint32), len(self.alphabet)
        for first in self.firsts[::-1]:
            rule = seq >= first
            if not rule.any():
                continue
            place = np.arange(len(seq)) + np.cumsum(rule) - rule
            out = np.empty(len(seq) + int(rule.sum()), np.uint32)
            out[place] = np.where(rule, self.left[np.where(rule, seq - n, 0)], seq)
            out[place[rule] + 1] = self.right[seq[rule] - n]
            seq = out
        return self.alphabet[seq]

    def sizes(self) -> np.ndarray:
        """Tokens of each document, from expansion lengths alone."""
        total = np.concatenate([[0], np.cumsum(self.lengths[self.symbols], dtype=np.int64)])
        return np.diff(total[self.starts])

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Tokens [start, stop) of a document; only symbols that reach into that range are expanded."""
        own = self.symbols[self.starts[i]:self.starts[i + 1]]
        ends = np.cumsum(self.lengths[own], dtype=np.int64)
        stop = int(ends[-1]) if stop is None else min(stop, int(ends[-1]))
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skip = start - (int(ends[a - 1]) if a else 0)
        return self.expand(own[a:b])[skip:skip + stop - start]


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end: int = 0, doc_id: str = "doc_id", text: str = "text",
                 shard_tokens: int = 1 << 20, max_chunks: int = 5 * MAX_CHUNKS // 2) -> None:
    """Encodes texts with a byte-level BPE file and writes the store to ``folder``.

    ``max_chunks``: size of a worker's memory of chunks, not of any result.
    """
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = f.read()
    source = docs.sparkSession.sparkContext.broadcast((vocabulary, ByteBPE(vocabulary).irregular()))
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_coder(source.value[0], keep_space=True, irregular=source.value[1], max_chunks=max_chunks)
        part, start, shard = TaskContext.get().partitionId(), 0, 0
        names: list[pa.Array] = []
        blocks: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal start, shard
            ids, n = np.concatenate(blocks), np.concatenate(sizes)
            owners = pa.concat_arrays(names)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([start], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(owners)], pa.int32()), owners), pa.array([repair(ids, n)], pa.binary())],
                ["part", "shard", "start", "n_tokens", "doc_ids", "payload"])
            start, shard = start + len(ids), shard + 1
            for x in (names, blocks, sizes):
                x.clear()
            return row

        for batch in slices(batches, max_bytes=SLICE_BYTES // 2):
            ids, bounds = coder.encode(batch.column(1))
            n = np.diff(bounds) + 1
            stops = np.cumsum(n)
            stream = np.full(int(stops[-1]), end, np.uint32)
            inside = np.ones(len(stream), bool)
            inside[stops - 1] = False
            stream[inside] = ids
            a = 0
            while a < len(n):
                held = sum(map(len, blocks))
                b = int(np.searchsorted(stops, (stops[a - 1] if a else 0) + shard_tokens - held, "right"))
                if b <= a:
                    if blocks:
                        yield flush()
                        continue
                    b = a + 1
                names.append(batch.column(0).slice(a, b - a))
                blocks.append(stream[stops[a] - n[a]:stops[b - 1]])
                sizes.append(n[a:b])
                a = b
        if blocks:
            yield flush()

    (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(run, f"part int, shard int, start long, n_tokens long, doc_ids array<{kind}>, payload binary")
     .write.option("compression", "zstd").parquet(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and ids (binary, 32-bit little-endian) of the whole store."""
    shards = spark.read.parquet(folder)
    kind = dict(shards.dtypes)["doc_ids"][len("array<"):-1]
    # one row for each range of documents; the running sum over these few rows places the ranges
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    placed = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    rows = shards.join(placed, "part").select((F.col("start") + F.col("before")).alias("start"), "doc_ids", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard(batch.column(2)[i].as_buffer().to_pybytes())
                raw, n = shard.expand(shard.symbols).astype("<u4").tobytes(), shard.sizes()
                stops = np.cumsum(n)
                blobs = [raw[4 * a:4 * b] for a, b in zip((stops - n).tolist(), stops.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[i].values, pa.array(stops - n + batch.column(0)[i].as_py(), pa.int64()), pa.array(n, pa.int64()),
                     pa.array(blobs, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids binary")


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = scratch(spark, "tokens")
    write_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), folder)
    return read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
