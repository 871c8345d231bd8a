"""Byte-level BPE encoding and decoding (operator 1).

Merging keeps a priority queue of (rank, position) over a doubly linked list of
symbols; an entry whose symbols have changed since it was queued is stale and
is skipped.  Decoding puts the byte strings of the vocabulary together.

Vocabulary files are data: the driver reads the file once (its size is fixed by
the vocabulary) and the tasks get it as a broadcast value.

Cases.  Null text counts as empty; an empty text has no ids and decodes to ''.
Repeated rows are encoded each for itself.  Columns beside the text pass
through; a column already named like an output is replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import SLICE_BYTES, documents, slices, with_fields
from .wordcodes import WHITE, WordCoder

# The published pre-tokenizer pattern of byte-level BPE.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class ByteBPE:
    """Encoder and decoder of one vocabulary file (its JSON text)."""

    def __init__(self, source: str, max_pieces: int = 200_000) -> None:
        model = json.loads(source)
        vocab, letters = model["model"]["vocab"], byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_id = [vocab[c] for c in letters]
        self.ranks: dict[int, int] = {}  # of a pair of ids
        self.joined: list[int] = []  # of a rank
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(vocab[left] << 32 | vocab[right], rank)
            self.joined.append(vocab[left + right])
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        strings = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.strings = [b""] * (max(strings) + 1)
        for i, s in strings.items():
            self.strings[i] = (bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode())
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.marks = {t[0] for t in self.special}  # a text without these characters has no special token
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, list[int]] = {}
        self.max_pieces = max_pieces

    def irregular(self) -> str:
        """Pattern of texts that can't be cut before every space (see wordcodes)."""
        ends = "|".join([rf"[{WHITE}]", r"\z", *map(regex.escape, self.special)])
        return f"[{WHITE}] (?:{ends})"

    def merge(self, symbols: list[int]) -> list[int]:
        """Ids of a list of byte ids after all merges."""
        n, rank_of, joined = len(symbols), self.ranks.get, self.joined
        if n < 2:
            return symbols
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # of each place, the rank of the pair that begins there (-1: none); rank and place of a queue's entry are one number
        ranks = [rank_of(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:])]
        ranks.append(-1)
        queue = [r << 32 | i for i, r in enumerate(ranks) if r >= 0]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i, rank = entry & 0xFFFFFFFF, entry >> 32
            if ranks[i] != rank:
                continue  # stale
            j, h = after[i], before[i]
            k = after[j]
            symbols[i] = new = joined[rank]
            symbols[j] = ranks[i] = ranks[j] = -1
            after[i] = k
            if k >= 0:
                before[k] = i
                found = rank_of(new << 32 | symbols[k])
                if found is not None:
                    ranks[i] = found
                    heappush(queue, found << 32 | i)
            if h >= 0:
                found = rank_of(symbols[h] << 32 | new)
                if found is None:
                    ranks[h] = -1
                else:
                    ranks[h] = found
                    heappush(queue, found << 32 | h)
        return [s for s in symbols if s >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.cut.split(text) if any(map(text.__contains__, self.marks)) else [text]:
            if part in self.special:
                out.append(self.special[part])
                continue
            for piece in self.pieces.findall(part):
                ids = self.known.get(piece)
                if ids is None:
                    ids = self.merge(list(map(self.byte_id.__getitem__, piece.encode())))
                    if len(piece) <= 64:
                        if len(self.known) >= self.max_pieces:
                            self.known.clear()
                        self.known[piece] = ids
                out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


#: Chunks that a Python worker remembers: most of a text's chunks are few characters of a word, met again thousands of texts later.
MAX_CHUNKS = 600_000

_models: dict[int, tuple[ByteBPE, WordCoder]] = {}


def _model(source: str) -> tuple[ByteBPE, WordCoder]:
    """The model of a vocabulary, built once in each Python worker."""
    key = hash(source)
    if key not in _models:
        bpe = ByteBPE(source)
        _models[key] = bpe, WordCoder(lambda words: [bpe.encode(w) for w in words], bpe.irregular(), keep_space=True, max_chunks=MAX_CHUNKS, max_ids=10 * MAX_CHUNKS)
    return _models[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def bpe_encode(df: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids",
               decoded: str | None = None) -> DataFrame:
    """Replaces the text column by ``ids`` (binary: unsigned 32-bit little-endian) and ``n_tokens``.

    ``vocabulary``: path of a byte-level BPE file on the driver.  ``decoded``:
    also add, in the same pass, a column of this name with the ids decoded again.
    """
    source = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    added = [f"`{ids}` binary", "n_tokens long", *([f"`{decoded}` string"] if decoded else [])]
    outputs = [ids, "n_tokens", *([decoded] if decoded else [])]
    rest = df.drop(*outputs)
    names = [c for c in rest.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, coder = _model(source.value)
        for batch in slices(batches, text, SLICE_BYTES // 2):
            coded, starts = coder.encode(batch.column(batch.schema.get_field_index(text)))
            cuts = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
            raw = coded.astype("<u4").tobytes()
            out = [pa.array([raw[4 * a:4 * b] for a, b in cuts], pa.binary()), pa.array(np.diff(starts), pa.int64())]
            if decoded:
                out.append(pa.array([bpe.decode(coded[a:b].tolist()) for a, b in cuts], pa.string()))
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names), *out],
                                             [*names, *outputs])

    return rest.select(*names, text).mapInArrow(run, with_fields(rest.drop(text).schema.fields, ", ".join(added)))


def bpe_decode(df: DataFrame, vocabulary: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``: the string that the ids stand for (null ids: ''; broken UTF-8: U+FFFD)."""
    source = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    rest = df.drop(text)
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(source.value)[0]
        for batch in slices(batches, ids):
            blobs = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([bpe.decode(np.frombuffer(b or b"", "<u4").tolist()) for b in blobs], pa.string())],
                [*names, text])

    return rest.mapInArrow(run, with_fields(rest.schema.fields, f"`{text}` string"))


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe_encode(documents(spark, sf_dir), path, decoded="decoded")
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
