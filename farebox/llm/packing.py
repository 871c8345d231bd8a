"""Best-fit packing with certified bin counts (operator 8).

Documents become token ids, each with an end id; only documents longer than a
sequence are cut.  Pieces are dealt to groups of bounded size.  A group packs
its pieces by best-fit decreasing and computes a lower bound of the bins that
any packing of them needs, from dual-feasible functions.  If the bound equals
the bins, the group is certified: no packing of these pieces is better.  The
other groups put the pieces of their emptiest bins into a pool, a certified one
those of its emptiest bin if that isn't full; the pool is dealt to new groups and
packed again, until one group is left.

A group holds pieces' numbers, not their text.  Pieces are dealt by a hash of
their row number, salted anew each round, so no source or key makes a group
large, repeated and missing doc_ids included.

Cases.  Null text counts as empty: a document of the end id alone.  Rows that
repeat are packed each for itself.  Without rows there are no sequences.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .bpe import byte_letters
from .common import SLICE_BYTES, UNMARKED, documents, scratch, slices, store
from .wordcodes import WordCoder

#: Rows of a group in all rounds; a pool of fewer rows is one group.
GROUP_ROWS = 4096

#: Chunks that a Python worker remembers; a worker that has held other models before needs fewer (about 0.3 MB a thousand).
MAX_CHUNKS = 500_000

#: Bins that a group without certificate opens again: the room that it wastes is nearly all in its last bins.
LOOSE_BINS = 24

_coders: dict[int, WordCoder] = {}

#: Chunks of ASCII and Latin-1 letters, punctuation and single line ends: both kinds of file cut them between these runs and nowhere
#: else, and no normalising changes them but lower-casing.  Signs of contractions and special tokens are left out.
_MARKS = r"!-&(-/:;=?@\[-`{}~"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(rf"[{_LETTERS}{_MARKS}\n]+")
RUNS = re.compile(rf"[{_LETTERS}]+|[{_MARKS}]+|\n")
#: Both files hold a letter for each byte.
_AS_BYTES = {chr(c): "".join(byte_letters()[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


class PartCoder:
    """ids of chunks by the tokenizers library; of plain ones run by run.

    A run of letters is a token sequence of its own, so it goes straight to the
    library's BPE model, without normalising and cutting, and runs that many
    chunks share are encoded once.  All other chunks go through the whole tokenizer.
    ``max_runs``: size of the memory, not of any result.
    """

    def __init__(self, source: str, keep_space: bool, max_runs: int = 150_000) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = Tokenizer.from_str(source).model
        self.keep_space, self.max_runs = keep_space, max_runs
        self.runs: dict[str, list[int]] = {}

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def run(self, run: str) -> list[int]:
        ids = self.runs.get(run)
        if ids is None:
            letters = run[1:] if run[0] == " " else run
            if letters.isalpha():  # a byte-level file writes the space as a letter
                letters = letters if self.keep_space else letters.lower()
                if not letters.isascii():
                    letters = "".join([_AS_BYTES.get(c, c) for c in letters])
                ids = [t.id for t in self.model.tokenize(f"\u0120{letters}" if run[0] == " " else letters)]
            else:
                ids = self.whole([run])[0]
            if len(self.runs) >= self.max_runs:
                self.runs.clear()
            if len(run) <= 64:
                self.runs[run] = ids
        return ids

    def __call__(self, chunks: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(chunks)
        other, known, plain, cut = [], self.runs.get, PLAIN.fullmatch, RUNS.findall
        for i, chunk in enumerate(chunks):
            space = self.keep_space and chunk[:1] == " "
            if not plain(chunk, space) or "\n" in chunk and ("\n\n" in chunk or space and chunk[1] == "\n"):
                other.append(i)
                continue
            ids = known(chunk)  # a chunk of one run
            if ids is None:
                first, *more = cut(chunk, space)
                ids = self.run(f" {first}" if space else first)
                for run in more:
                    ids = ids + (known(run) or self.run(run))
            out[i] = ids
        for i, ids in zip(other, self.whole([chunks[i] for i in other])):
            out[i] = ids
        return out


def library_coder(source: str, keep_space: bool, irregular: str | None, max_chunks: int | None = None) -> WordCoder:
    """Chunk-wise encoding by the tokenizers library, built once in each Python worker.

    ``keep_space``: a byte-level file, whose tokens hold white space; else a
    lower-casing word file, whose tokens hold none.
    """
    max_chunks = max_chunks or (2 if keep_space else 1) * MAX_CHUNKS
    key = hash((source, keep_space, max_chunks))
    if key not in _coders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _coders[key] = WordCoder(PartCoder(source, keep_space), irregular, keep_space, max_chunks, max_ids=max(5_000_000, 6 * max_chunks))
    return _coders[key]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, doc_id: str = "doc_id", text: str = "text",
           max_chunks: int = MAX_CHUNKS) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece.

    ``tokenizer``: path of a tokenizers file whose tokens hold no white space, so that texts can be cut at spaces.
    ``max_chunks``: size of a worker's memory of chunks, not of any result.
    """
    with open(tokenizer, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = library_coder(source.value, keep_space=False, irregular=None, max_chunks=max_chunks)
        for batch in slices(batches, max_bytes=SLICE_BYTES // 2):
            ids, bounds = coder.encode(batch.column(1))
            sizes = np.diff(bounds) + 1
            stops = np.cumsum(sizes)
            stream = np.full(int(stops[-1]), end, "<u4")
            inside = np.ones(len(stream), bool)
            inside[stops - 1] = False
            stream[inside] = ids
            raw = memoryview(stream.tobytes())
            number = -(-sizes // capacity)
            of = np.repeat(np.arange(len(sizes)), number)
            piece = np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)
            start = piece * capacity
            length = np.minimum(capacity, sizes[of] - start)
            at = (stops - sizes)[of] + start
            crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return (docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
            .mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place of each item; an item goes into the fullest bin that it fits."""
    bins, places = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    rooms, n = 0, 0  # bit r of rooms: a bin with r left is open
    sizes = lengths.tolist()
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, n
            n += 1
        bins[i], places[i] = b, capacity - room
        room -= size
        if room:
            if not open_bins[room]:
                rooms |= 1 << room
            open_bins[room].append(b)
    return bins, places


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best of several dual-feasible functions.

    Each maps item sizes so that items which fit a bin have images that sum to
    at most 1; so the sum of all images is a lower bound.  The identity; for
    each threshold t, sizes over capacity - t count as a whole bin and sizes
    under t as nothing; and for k = 1, 2, ..., steps of 1 / k.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    area = count * size
    best = -(-int(area.sum()) // capacity)
    number, filled = np.cumsum(count), np.cumsum(area)
    t = np.arange(1, capacity // 2 + 1)
    large = number[-1] - number[capacity - t]
    middle = filled[capacity - t] - filled[t - 1]
    best = max(best, int((large + -(-middle // capacity)).max()))
    for k in range(1, 40):
        scaled = size * (k + 1)
        image = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # times k * capacity
        best = max(best, -(-int((count * image).sum()) // (k * capacity)))
    return best


def pack(pieces: DataFrame, folder: str, capacity: int = 2048, group_rows: int = GROUP_ROWS, loose_bins: int = LOOSE_BINS) -> DataFrame:
    """Adds sequence_id and offset.  ``folder``: a shared folder for the pieces and each round's result.

    Rounds end when one group is left, or when a round has settled nothing.
    """
    spark = pieces.sparkSession
    rest = pieces.drop("sequence_id", "offset")
    pool = store(rest.select(F.monotonically_increasing_id().alias("_row"), F.col("length").alias("_length"),
                             F.struct(*(F.col(f"`{c}`") for c in rest.columns)).alias("_piece")), f"{folder}/pieces")
    row, left, before = pool.schema["_piece"].dataType, pool.count(), None
    done, number = [], 0
    while True:
        groups = max(1, -(-left // group_rows))
        last = groups == 1 or left == before
        shift = number << 56

        def run(key: tuple, rows: pa.Table) -> pa.Table:
            # by length, then by number: an order of their own
            rows = rows.sort_by([("_length", "descending"), ("_row", "ascending")])
            lengths = rows["_length"].to_numpy()
            bins, places = best_fit_decreasing(lengths, capacity)
            used = np.bincount(bins, lengths)
            certified = len(used) == lower_bound(lengths, capacity)
            loose = np.zeros(len(used), bool)
            if not last:  # noqa: B023  a certified group's rest also goes on, to meet those of the others
                loose[np.argsort(used, kind="stable")[:1 if certified else loose_bins]] = True
            settled = ~(loose & (used < capacity))[bins]
            return (rows.drop_columns(["_grp"]).append_column("_offset", pa.array(places))
                    .append_column("_sequence", pa.array(shift + (key[0].as_py() << 24) + bins))  # noqa: B023
                    .append_column("_settled", pa.array(settled)))

        columns = f"_row long, _length long, _piece {row.simpleString()}, _offset long, _sequence long, _settled boolean"
        (pool.withColumn("_grp", F.pmod(F.xxhash64("_row", F.lit(number)), F.lit(groups)))
         .groupBy("_grp").applyInArrow(run, columns)
         .write.options(**UNMARKED).partitionBy("_settled").parquet(f"{folder}/round-{number}"))
        result = spark.read.schema(columns).parquet(f"{folder}/round-{number}")
        done.append(result.where("_settled").select("_piece.*", F.col("_sequence").alias("sequence_id"), F.col("_offset").alias("offset")))
        if last:
            break
        pool = result.where("not _settled").select("_row", "_length", "_piece")
        number, before, left = number + 1, left, pool.count()
        if not left:
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out


def pack_documents(docs: DataFrame, spark: SparkSession, max_chunks: int = MAX_CHUNKS) -> DataFrame:
    import public_tokenizers
    return pack(pieces(docs, public_tokenizers.path("word_bpe_49k.json"), max_chunks=max_chunks), scratch(spark, "packing"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), spark, max_chunks=3 * MAX_CHUNKS)
