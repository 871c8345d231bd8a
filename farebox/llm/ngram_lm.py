"""Language-model scoring with a weighted backoff automaton (operator 10).

The model is a bigram model with Dirichlet smoothing towards smoothed unigram
frequencies.  As an automaton: a state for each word (and one for the start of
a text), an arc for each bigram seen in training with its smoothed
log-probability, and a failure arc from each state to the root, whose weight is
what the state's seen words leave over; the root has an arc for every token.
A text is read once from left to right: an arc if the state has one, else the
failure arc and then the root's.

The model grows with the corpus, so no task ever holds it.  Texts are dealt to
blocks of bounded size.  A block asks for exactly the n-grams it has: it sends
its distinct n-gram hashes with their training counts to hash ranges
(``buckets``); a bucket adds up what all blocks sent and answers every block
with the totals in the block's own order; the block then builds the part of the
automaton that its texts can reach.  A frequent word costs one entry a block,
so it makes no bucket large.

N-grams are 64-bit hashes; two that collide would share a count (odds of about
n^2 / 2^65 for n distinct n-grams).

Cases.  Null text counts as empty: its only token is the end.  Without any
training text N and V are 0 and all scores are defined.  Repeated rows are
scored each for itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import ascii_words, documents, fold, per_text, text_bytes

START, END = (np.uint64(xxhash.xxh3_64_intdigest(x, seed=1)) for x in ("start", "end"))


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of bigrams."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + right
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Block:
    """The tokens of some texts and their distinct n-grams."""

    def __init__(self, texts: pa.Array, train: np.ndarray) -> None:
        words, sizes = ascii_words(pc.ascii_lower(texts))
        coded = words.dictionary_encode()
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64,
                             len(coded.dictionary))
        self.sizes = sizes + 1  # with the end
        ends = np.cumsum(self.sizes) - 1
        tokens = np.full(int(self.sizes.sum()), END, np.uint64)
        inside = np.ones(len(tokens), bool)
        inside[ends] = False
        if len(words):
            tokens[inside] = hashes[np.asarray(coded.indices)]
        before = np.concatenate([[START], tokens[:-1]]) if len(tokens) else tokens
        before[ends - self.sizes + 1] = START
        weight = np.repeat(np.asarray(train, np.float64), self.sizes)
        self.one, self.one_of = np.unique(tokens, return_inverse=True)
        self.two, self.two_of = np.unique(pair_keys(before, tokens), return_inverse=True)
        self.one_counts = np.bincount(self.one_of, weight, len(self.one)).astype(np.uint32)
        self.two_counts = np.bincount(self.two_of, weight, len(self.two)).astype(np.uint32)
        self.starts = ends - self.sizes + 1

    def requests(self, buckets: int) -> list[tuple[bytes, bytes, bytes, bytes]]:
        """For each range of hashes: unigrams and their training counts, bigrams and theirs."""
        edges = np.array([i * 2**64 // buckets for i in range(1, buckets)], np.uint64)
        out = []
        cut_one = [0, *np.searchsorted(self.one, edges).tolist(), len(self.one)]
        cut_two = [0, *np.searchsorted(self.two, edges).tolist(), len(self.two)]
        for i in range(buckets):
            a, b = slice(cut_one[i], cut_one[i + 1]), slice(cut_two[i], cut_two[i + 1])
            out.append((self.one[a].tobytes(), self.one_counts[a].tobytes(), self.two[b].tobytes(), self.two_counts[b].tobytes()))
        return out


class BackoffAutomaton:
    """The arcs that a block's texts can take, from counts of the whole training text."""

    def __init__(self, block: Block, one: np.ndarray, two: np.ndarray, n_tokens: int, n_types: int, mass: float) -> None:
        self.block, self.counts = block, one
        probability = (one + 0.1) / (n_tokens + 0.1 * (n_types + 1))
        self.root = np.log10(probability)
        ended = int(one[block.one.searchsorted(END)]) if len(block.one) else 0
        history = np.concatenate([[0], one[block.one_of][:-1]]).astype(np.float64) if len(block.one_of) else np.empty(0)
        history[block.starts] = ended  # every training text has one start and one end
        self.failure = np.log10(mass / (history + mass))
        seen = two[block.two_of]
        with np.errstate(divide="ignore"):
            self.arc = np.where(seen > 0, np.log10((seen + mass * probability[block.one_of]) / (history + mass)), -np.inf)

    def traverse(self) -> np.ndarray:
        """log10 probability of each text, one pass over its tokens."""
        step = np.where(np.isneginf(self.arc), self.failure + self.root[self.block.one_of], self.arc)
        return per_text(step, self.block.sizes)

    def base(self) -> np.ndarray:
        return per_text(self.root[self.block.one_of], self.block.sizes)

    def known(self) -> np.ndarray:
        return per_text((self.counts[self.block.one_of] > 0).astype(np.int64), self.block.sizes)


def lm_score(docs: DataFrame, held_out: str, doc_id: str = "doc_id", text: str = "text", mass: float = 20.0,
             block_bytes: int = 8 << 20, bucket_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    Rows whose boolean ``held_out`` column is false are the training text.
    ``mass``: how many tokens of unigram frequencies every state has besides its
    own.  ``block_bytes``/``bucket_bytes``: text a block holds and text whose
    n-grams a bucket holds; they set the number of tasks, not any result.
    """
    total = text_bytes(docs, text)
    blocks, buckets = max(1, -(-total // block_bytes)), max(1, -(-total // bucket_bytes))
    dealt = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(held_out).alias("held_out"),
                        F.pmod(F.xxhash64(doc_id, F.octet_length(text)), F.lit(blocks)).cast("int").alias("block"))

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        block = Block(rows["text"], ~np.asarray(rows["held_out"].combine_chunks()))
        one, one_n, two, two_n = zip(*block.requests(buckets))
        return pa.table({"block": pa.array([key[0].as_py()] * buckets, pa.int32()), "bucket": pa.array(range(buckets), pa.int32()),
                         "one": one, "one_n": one_n, "two": two, "two_n": two_n})

    def answer(rows: pa.Table) -> pa.Table:
        n = rows.num_rows
        result = {"block": rows["block"], "bucket": rows["bucket"]}
        for name in ("one", "two"):
            keys = [np.frombuffer(x, np.uint64) for x in rows[name].to_pylist()]
            counts = [np.frombuffer(x, np.uint32) for x in rows[f"{name}_n"].to_pylist()]
            distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
            sums = np.zeros(len(distinct), np.uint64)
            np.add.at(sums, of, np.concatenate(counts).astype(np.uint64))
            if not len(sums) or sums.max() < 1 << 32:  # the width of the answers follows the largest count
                sums = sums.astype(np.uint32)
            result[f"{name}_bytes"] = pa.array([sums.itemsize] * n, pa.int32())
            back = np.split(sums[of], np.cumsum([len(k) for k in keys])[:-1])
            result[name] = pa.array([x.tobytes() for x in back], pa.binary())
            if name == "one":
                result["n_tokens"] = pa.array([int(sums.sum(dtype=np.uint64))] * n, pa.int64())
                result["n_types"] = pa.array([int((sums > 0).sum())] * n, pa.int64())
        return pa.table(result)

    def score(rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows["text"], ~np.asarray(rows["held_out"].combine_chunks()))
        answers = answers.sort_by("bucket")
        one, two = (np.concatenate([np.frombuffer(x, f"<u{w}").astype(np.uint64) for x, w in zip(answers[c].to_pylist(), answers[f"{c}_bytes"].to_pylist())])
                    for c in ("one", "two"))
        n_tokens = pc.sum(answers["n_tokens"]).as_py()
        automaton = BackoffAutomaton(block, one, two, n_tokens, pc.sum(answers["n_types"]).as_py(), mass)
        return pa.table({
            "doc_id": rows["doc_id"], "held_out": rows["held_out"], "n_tokens": block.sizes.astype(np.int64),
            "n_known": automaton.known(), "train_tokens": pa.array([n_tokens] * rows.num_rows, pa.int64()),
            "base_score": automaton.base(), "score": automaton.traverse()})

    kind = dict(docs.dtypes)[doc_id]
    asked = dealt.groupBy("block").applyInArrow(ask, "block int, bucket int, one binary, one_n binary, two binary, two_n binary")
    answered = asked.groupBy("bucket").applyInArrow(answer, "block int, bucket int, one_bytes int, one binary, n_tokens long, n_types long, two_bytes int, two binary")
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", fold(F.col("doc_id"), 10) == 0)
    return lm_score(docs, "held_out")
