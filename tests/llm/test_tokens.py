"""Operators 1, 4 and 8 against the tokenizers library and exact round trips."""

import gc
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from farebox.llm import bpe, packing, wordcodes  # noqa: E402
from farebox.llm.bpe import ByteBPE, WordCoder, bpe_decode, bpe_encode, read_vocabulary  # noqa: E402
from farebox.llm.packing import best_fit_decreasing, library_coder, lower_bound, pack, pieces  # noqa: E402
from farebox.llm.token_store import Shard, read_tokens, repair, write_tokens  # noqa: E402

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def library(path):
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def random_texts(n, seed):
    r = random.Random(seed)
    letters = [*" \n\t  aab'sTé漢字🙂́\x1c\x85 　\xa0,.!1²ⅧΣσ ", "<|endoftext|>", "'ll", " the", "İ"]
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(n)]


def test_the_tokenizer_gets_bounded_parts(monkeypatch):
    monkeypatch.setattr(wordcodes, "PART", 7)
    t, got = library(BYTES), []

    def encode(xs):
        got.append(xs)
        return [e.ids for e in t.encode_batch_fast(xs, add_special_tokens=False)]

    texts = random_texts(300, 5)
    irregular = ByteBPE(read_vocabulary(BYTES)).irregular()
    odd = pc.match_substring_regex(pa.array(texts), irregular).to_pylist()
    assert 2 < sum(odd) < len(texts)
    ids, at = WordCoder(encode, irregular, keep_space=True).encode(pa.array(texts))
    assert max(map(len, got)) <= 7
    assert all(len(xs) == 1 for xs in got for x in xs if x in {y for y, o in zip(texts, odd) if o and len(y) > 20})
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_the_store_remembers_more_chunks_than_a_slice_has():
    coder = library_coder(read_vocabulary(BYTES), True, None)
    first = pa.array([" ".join(f"a{i}" for i in range(600_000))])
    coder.encode(first)
    coder.encode(pa.array(["b"]))
    assert len(coder.slot) > 600_000  # not forgotten after one large slice
    coder._forget()


def test_packing_remembers_more_chunks_where_a_worker_has_room():
    coder = library_coder(open(WORDS, encoding="utf-8").read(), False, None, max_chunks=1_500_000)
    coder.encode(pa.array([" ".join(f"a{i}" for i in range(600_000))]))
    coder.encode(pa.array(["b"]))
    assert len(coder.slot) > 600_000
    coder._forget()


def test_no_search_for_cycles_while_chunks_are_learnt():
    seen = []
    coder = WordCoder(lambda xs: [seen.append(gc.isenabled()) or [len(x)] for x in xs], None, keep_space=False)
    assert gc.isenabled()
    assert coder.encode(pa.array(["a bc", "bc d"]))[0].tolist() == [1, 2, 2, 1]
    assert seen == [False] * 3 and gc.isenabled()


def test_plain_chunks_are_encoded_run_by_run():
    """Equal to the whole tokenizer for all kinds of chunks; only chunks that aren't plain, and marks, reach it."""
    r = random.Random(5)
    signs = ["a", "B", "the", "Ing", "Hello", ".", ",", "!!", "###", "$", "&", "*", "(", "]", "`", "~", "\\", "^", "_", "-", "@", ";", "=", "}", "\n", "\n\n", "\t",
             "'", "'s", "<", "|", ">", "<|endoftext|>", "<|STARTOFTEXT|>", "é", "e\u0301", "漢", "7", "42", "\r", "\u00a0", "K\u0130"]
    chunks = ["", " ", "\n", " \n", " \nx", "x\n", "x" * 3000, " " + "Ab" * 40, *("".join(r.choices(signs, k=r.randint(1, 5))) for _ in range(3000))]
    chunks += [" " + c for c in chunks]
    for name, keep in (("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)):
        source = read_vocabulary(public_tokenizers.path(name))
        coder = packing.PartCoder(source, keep, max_runs=100)
        full = library(public_tokenizers.path(name))
        assert coder(chunks) == [full.encode(c, add_special_tokens=False).ids for c in chunks]
        sent = []
        coder = packing.PartCoder(source, keep)
        coder.whole = lambda xs, whole=coder.whole: sent.extend(xs) or whole(xs)
        coder([f"Word{'ab'[i % 2] * (i // 2)}.\nNext,#" for i in range(60)])
        assert sorted(sent) == sorted({",#", "."} | ({"\n"}))


def test_latin_letters_are_encoded_run_by_run():
    """Equal to the whole tokenizer; chunks of Latin-1 letters don't reach it, those with other characters do."""
    r = random.Random(6)
    signs = [*map(chr, range(0xC0, 0x180)), "a", "B", ".", "\n", "\u0301", "\u00d7", "\u00f7", "\u00aa"]
    chunks = ["", "\u00df", *("".join(r.choices(signs, k=r.randint(1, 6))) for _ in range(3000))]
    chunks += [" " + c for c in chunks]
    for path, keep in ((BYTES, True), (WORDS, False)):
        coder, full, sent = packing.PartCoder(read_vocabulary(path), keep, max_runs=100), library(path), []
        assert coder(chunks) == [full.encode(c, add_special_tokens=False).ids for c in chunks]
        coder.whole = lambda xs: sent.extend(xs) or [[0]] * len(xs)  # noqa: B023
        coder(["\u00c9l\u00e8ve", "stra\u00dfe", "\u00fcber", "\u0159eka"])
        assert sent == ["\u0159eka"]


def test_own_encoder_remembers_more_chunks_than_a_slice_has():
    coder = bpe._model(read_vocabulary(BYTES))[1]
    coder._forget()
    coder.encode(pa.array([" ".join(f"a{i}" for i in range(400_000))]))
    coder.encode(pa.array(["b"]))
    assert len(coder.slot) > 400_000  # not forgotten after one large slice
    coder._forget()


def test_each_new_word_is_looked_up_once():
    class Slots(dict):
        asked = 0

        def get(self, *key):
            Slots.asked += 1
            return super().get(*key)

    coder = WordCoder(lambda xs: [[len(x)] for x in xs], None, keep_space=True)
    coder.slot = Slots()
    assert coder.encode(pa.array(["a bc d", "a", "bc a"]))[0].tolist() == [1, 3, 2, 1, 2, 2]
    assert Slots.asked == 3 + 2  # the different words, then the different first ones


def test_byte_bpe_equals_the_library():
    t, texts = library(BYTES), random_texts(3000, 1)
    bpe = ByteBPE(read_vocabulary(BYTES))
    coder = WordCoder(lambda xs: [bpe.encode(x) for x in xs], bpe.irregular(), keep_space=True, max_chunks=50)
    for a in range(0, len(texts), 500):  # several slices: the memory of chunks fills and is forgotten
        part = texts[a:a + 500]
        ids, at = coder.encode(pa.array(part))
        for i, want in enumerate(t.encode_batch(part, add_special_tokens=False)):
            got = ids[at[i]:at[i + 1]].tolist()
            assert got == want.ids
            assert bpe.decode(got) == t.decode(want.ids, skip_special_tokens=False)


def test_word_bpe_by_chunks_equals_the_library():
    t, texts = library(WORDS), random_texts(2000, 2)
    ids, at = library_coder(open(WORDS, encoding="utf-8").read(), False, None).encode(pa.array(texts))
    for i, want in enumerate(t.encode_batch(texts, add_special_tokens=False)):
        assert ids[at[i]:at[i + 1]].tolist() == want.ids


def test_bpe_on_odd_rows(spark, odd, none):
    coded = bpe_encode(odd.selectExpr("*", "'mine' as n_tokens", "7 as extra"), BYTES)
    rows = bpe_decode(coded, BYTES).collect()
    t = library(BYTES)
    assert len(rows) == odd.count() and {r.extra for r in rows} == {7}
    for r, (_, text) in zip(rows, [(x.doc_id, x.text) for x in odd.collect()]):
        want = t.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == (text or "")
    assert bpe_encode(none, BYTES, decoded="again").collect() == []


def test_repair_round_trip_and_random_access():
    r = np.random.default_rng(3)
    for _ in range(60):
        sizes = r.integers(1, 40, r.integers(1, 30))
        ids = r.integers(0, r.choice([1, 2, 5, 60]), sizes.sum()).astype(np.uint32)
        shard = Shard(repair(ids, sizes, min_count=2, min_gain=0))
        assert (shard.expand(shard.symbols) == ids).all() and (shard.sizes() == sizes).all()
        starts = np.cumsum(sizes) - sizes
        for i, n in enumerate(sizes.tolist()):
            a = int(r.integers(0, n + 1))
            b = int(r.integers(a, n + 1))
            assert (shard.document(i, a, b) == ids[starts[i] + a:starts[i] + b]).all()
    text = np.tile(np.arange(40, dtype=np.uint32), 500)
    assert len(repair(text, np.array([len(text)]))) < text.nbytes / 10


def test_token_store_on_odd_rows(spark, odd, none, folder):
    write_tokens(odd, BYTES, f"{folder}/a", shard_tokens=50)
    got = read_tokens(spark, f"{folder}/a").orderBy("start").collect()
    t, start = library(BYTES), 0
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for g, r in zip(got, rows):
        want = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        assert (g.start, g.n_tokens, np.frombuffer(g.ids, "<u4").tolist()) == (start, len(want), want)
        start += len(want)
    write_tokens(none, BYTES, f"{folder}/b")
    assert read_tokens(spark, f"{folder}/b").collect() == []


def test_token_store_with_a_memory_that_is_forgotten_again_and_again(spark, odd, folder):
    for name, chunks in (("few", 2), ("many", 1_500_000)):
        write_tokens(odd, BYTES, f"{folder}/{name}", shard_tokens=50, max_chunks=chunks)
    few, many = (read_tokens(spark, f"{folder}/{name}").orderBy("start").collect() for name in ("few", "many"))
    assert few == many and len(few) == odd.count()


def test_best_fit_and_bounds_against_exhaustive_search():
    def fewest(sizes, capacity, bins=()):
        if not sizes:
            return len(bins)
        head, rest = sizes[0], sizes[1:]
        tries = {b: i for i, b in enumerate(bins) if b + head <= capacity}
        found = [fewest(rest, capacity, (*bins[:i], b + head, *bins[i + 1:])) for b, i in tries.items()]
        return min([*found, fewest(rest, capacity, (*bins, head))])

    r = np.random.default_rng(4)
    for _ in range(60):
        lengths = r.integers(1, 21, r.integers(1, 8))
        bins, places = best_fit_decreasing(lengths, 20)
        best = fewest(sorted(lengths.tolist(), reverse=True), 20)
        assert lower_bound(lengths, 20) <= best <= bins.max() + 1
        for b in set(bins.tolist()):
            mine = sorted(zip(places[bins == b].tolist(), lengths[bins == b].tolist()))
            assert mine[0][0] == 0 and all(p + n == q for (p, n), (q, _) in zip(mine, mine[1:]))
            assert sum(mine[-1]) <= 20


def test_packing_on_odd_rows(spark, odd, none, folder):
    cut = pieces(odd, WORDS, capacity=64)
    rows = pack(cut, f"{folder}/a", capacity=64, group_rows=40, loose_bins=2).collect()
    t, want = library(WORDS), []
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        want += [(r.doc_id, k // 64, k, len(ids[k:k + 64]), zlib.crc32(np.array(ids[k:k + 64], "<u4").tobytes())) for k in range(0, len(ids), 64)]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 64
    assert len(filled) <= -(-sum(filled.values()) // 64) + 2
    assert pack(pieces(none, WORDS), f"{folder}/b").collect() == []


def test_rests_of_certified_groups_meet(spark, folder):
    r = random.Random(3)
    lengths = [r.randint(3, 20) for _ in range(6000)]
    cut = spark.createDataFrame([(i, 0, n) for i, n in enumerate(lengths)], "doc_id long, piece int, length long")
    rows = pack(cut, folder, capacity=256, group_rows=200).collect()
    assert sorted(x.length for x in rows) == sorted(lengths)
    filled = {}
    for x in sorted(rows, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == filled.get(x.sequence_id, 0)
        filled[x.sequence_id] = x.offset + x.length
    assert max(filled.values()) <= 256 and len(filled) <= -(-sum(lengths) // 256) + 1
