"""Token ids of whole texts through a dictionary of space-separated chunks.

A text is cut before every space.  For the tokenizers used here the ids of a
text are the ids of its chunks put together, unless a run of white space has a
space strictly inside; texts with such a run (``irregular``) are encoded whole.
The distinct chunks of a slice are found by Arrow, only chunks not met before
reach the tokenizer, and numpy lays the ids out again.  The memory of chunks
met before is bounded: it is forgotten when it is full.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import spread, string_array

#: Characters with the Unicode property White_Space.
WHITE = "\t-\r \x85\xa0  -     　"

#: Chunks that the tokenizer gets at once: its result takes some hundred bytes a chunk.
PART = 10_000


@contextmanager
def uncollected() -> Iterator[None]:
    """No search for reference cycles inside: chunks give many lists of ids and no cycle, and each search would pass over all that are alive."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


class WordCoder:
    """``encode_chunks(list of str) -> list of id sequences`` gives the ids of texts or chunks.

    ``irregular``: an RE2 pattern; texts that match it are encoded whole.
    ``max_chunks``/``max_ids``: size of the memory, not of any result.
    """

    def __init__(self, encode_chunks: Callable[[list[str]], list[Sequence[int]]], irregular: str | None,
                 keep_space: bool, max_chunks: int = 300_000, max_ids: int = 3_000_000) -> None:
        self.encode_chunks, self.irregular, self.space = encode_chunks, irregular, " " if keep_space else ""
        self.max_chunks, self.max_ids = max_chunks, max_ids
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.start, self.length = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)

    def _slots(self, words: list[str]) -> np.ndarray:
        """Where the ids of words, all of them different, are."""
        found = np.fromiter(map(self.slot.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new, first = list(map(words.__getitem__, missing.tolist())), len(self.slot)
            for start in range(0, len(new), PART):
                part = new[start:start + PART]
                with uncollected():
                    self._learn(part, self.encode_chunks(part))
            found[missing] = np.arange(first, first + len(new))
        return found

    def _learn(self, words: list[str], coded: list[Sequence[int]]) -> None:
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        first, need = len(self.slot), self.used + int(sizes.sum())
        while len(self.ids) < need:
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.start) < first + len(words):
            self.start = np.concatenate([self.start, np.empty_like(self.start)])
            self.length = np.concatenate([self.length, np.empty_like(self.length)])
        ends = self.used + np.cumsum(sizes)
        self.ids[self.used:need] = np.fromiter(chain.from_iterable(coded), np.uint32, need - self.used)
        self.start[first:first + len(words)] = ends - sizes
        self.length[first:first + len(words)] = sizes
        self.used = need
        self.slot.update(zip(words, range(first, first + len(words))))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids (uint32) of all texts one after another, and where each text starts (n + 1 numbers)."""
        texts = string_array(column)
        if len(self.slot) > self.max_chunks or self.used > self.max_ids:
            self._forget()
        odd = np.zeros(len(texts), bool)
        if self.irregular:
            odd = np.asarray(pc.match_substring_regex(texts, self.irregular))
        if not odd.any():
            return self._regular(texts)
        plain_ids, plain = self._regular(texts.filter(pa.array(~odd)))
        whole = [np.asarray(self.encode_chunks([x])[0], np.uint32) for x in texts.filter(pa.array(odd)).to_pylist()]
        parts, i, j = [], 0, 0
        for is_odd in odd:
            if is_odd:
                parts.append(whole[j])
                j += 1
            else:
                parts.append(plain_ids[plain[i]:plain[i + 1]])
                i += 1
        starts = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=starts[1:])
        return np.concatenate(parts), starts

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64)
        lists = pc.split_pattern(texts, " ")
        bounds = np.asarray(lists.offsets, dtype=np.int64)
        bounds = bounds - bounds[0]
        coded = lists.flatten().dictionary_encode()
        codes = np.asarray(coded.indices, dtype=np.int64)
        words = coded.dictionary.to_pylist()
        firsts = codes[bounds[:-1]]
        slots = self._slots([self.space + w for w in words])[codes]
        if self.space:  # a text's first chunk has no space before it
            kinds, of = np.unique(firsts, return_inverse=True)
            slots[bounds[:-1]] = self._slots([words[c] for c in kinds.tolist()])[of]
        lengths = self.length[slots]
        ids = self.ids[spread(self.start[slots], lengths)]
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        return ids, ends[bounds]
