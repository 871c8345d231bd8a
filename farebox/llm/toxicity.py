"""Toxicity by class-conditional Kneser-Ney models (operator 9).

Two character n-gram models, one of toxic and one of ordinary text, read every
word from its start to its end.  Both discount their own counts and back off to
one model of the pooled counts: interpolated Kneser-Ney over all orders.  At the
highest order, and for n-grams that begin a word, a count is the number of
documents that have the word, so a word that one text repeats counts once; at
all other orders it is the continuation count, the number of distinct characters
seen before the n-gram (in any text, or in texts of the class).  The
discount of the class counts is large, so an expression that was seen in only a
few documents gets nearly the same probability in both classes, from the shared
counts, and only expressions with real evidence tell them apart.  Beside that,
each class model is mixed with the shared one, which bounds what one character
can say: else a count of 3 against 2 in a frequent context, or the first letters
of a toxic word in a harmless one, would count as much as the word itself.

A text's log-likelihoods are divided by its number of words.  Two such numbers
are compared: over all words, and over the words that are ``strong`` nats
likelier under the toxic model; a logistic function, fitted on labelled texts
that the models haven't counted, turns them into a score.

The score of a word depends on that word alone, so a task scores the distinct
words of a slice once.  The model is fitted on at most ``max_docs`` labelled
texts of each class (those with the least hash of their id), so it is small and
broadcast.  All their words count, also those of a single text, and all their
characters are told apart; other characters share one code.

Cases.  Null and empty texts, and texts without letters or digits, have no
words and get the score of a text without evidence.  Without labelled texts of
both classes every score is 0.  Repeated rows are scored each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import SLICE_BYTES, ascii_words, documents, fold, give_back, per_text, slices, table, with_fields

WORDS = re.compile(r"\w+")
BITS = 21  # of a character's code in an n-gram key, enough for all of Unicode; the other 43 are a hash of its context
FIRST, LAST, OTHER = 1, 2, 3
LONG = 12  # characters; a longer word's likelihood is normalised to this length


@dataclass
class Counts:
    """n-grams of one order: pooled counts, what discounting leaves of the class counts, and sums by context."""

    keys: np.ndarray
    pooled: np.ndarray
    own: np.ndarray  # 2 x n
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    class_total: np.ndarray  # 2 x contexts
    class_left: np.ndarray  # 2 x contexts: class_total less the sum of own


@dataclass
class Ratios:
    """n-grams of one order with their log-ratios of the class models, and the log-ratio after each context without one of them.

    What a known n-gram says depends on its own counts and those of its shorter
    forms, all known too; after a known context any other character gets the
    discounted rest in every model, so their ratio depends on the context alone.
    """

    keys: np.ndarray
    ratio: np.ndarray
    context: np.ndarray  # of each n-gram
    after: np.ndarray  # of each context


class Memory:
    """Sums of words met before, in rows of one array."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.values = np.zeros((1 << 12, 3))
        self.characters = 0

    def add(self, words: list[str], values: np.ndarray) -> None:
        first = len(self.slot)
        while len(self.values) < first + len(words):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        self.values[first:first + len(words)] = values
        self.slot.update(zip(words, range(first, first + len(words))))
        self.characters += sum(map(len, words))


@dataclass
class ToxicityModel:
    alphabet: np.ndarray
    orders: list[Counts]
    discount: float
    strong: float
    common: float = 0.02  # weight of the shared model beside a class model's 1
    max_words: int = 60_000  # bounds of a task's memory of words, not of any result
    max_characters: int = 2_000_000
    weights: np.ndarray = field(default_factory=lambda: np.zeros(3))
    trained: bool = False
    tables: list[Ratios] = field(default_factory=list)  # what scoring needs of the orders

    def scorer(self) -> ToxicityModel:
        """The model without its counts, for the tasks."""
        return replace(self, orders=[])

    # -- words to n-gram keys

    def codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Character codes of all words, each between FIRST and LAST, and the words' lengths so."""
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        known = at < len(self.alphabet)
        known[known] = self.alphabet[at[known]] == points[known]
        out = np.full(int(sizes.sum()), OTHER, np.uint64)
        ends = np.cumsum(sizes)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = inner[ends - sizes] = False
        out[inner] = np.where(known, at + OTHER + 1, OTHER)
        out[ends - 1], out[ends - sizes] = LAST, FIRST
        return out, sizes

    @staticmethod
    def keys(codes: np.ndarray, sizes: np.ndarray, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order, of each character after FIRST: the key of it and the order - 1 before it; and whether there are as many."""
        place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        inner = place > 0
        mixed, before, factor = _mix(codes), np.zeros(len(codes), np.uint64), np.uint64(1)
        for back in range(order):
            if back:
                factor = np.uint64(int(factor) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
                before[back:] += mixed[:-back] * factor
            key = _mix(before) >> np.uint64(BITS) << np.uint64(BITS) | codes
            yield key[inner], (place >= back)[inner]

    # -- scoring

    def ratios(self, words: list[str]) -> np.ndarray:
        """log P(word | toxic) - log P(word | ordinary) of each word, of a long one for as many as LONG characters."""
        codes, sizes = self.codes(words)
        n = len(codes) - len(sizes)
        ratio, open_ = np.zeros(n), np.arange(n)
        grams = list(zip(self.tables, self.keys(codes, sizes, len(self.tables))))
        for c, (key, whole) in reversed(grams):  # the longest known context decides
            at = open_[whole[open_]]
            # equal n-grams once, in the order of the table: far cheaper to find
            asked, of = np.unique(key[at], return_inverse=True)
            j = np.minimum(np.searchsorted(c.keys, asked), len(c.keys) - 1)
            hit, before = c.keys[j] == asked, np.maximum(j - 1, 0)
            near = np.where(c.keys[j] >> np.uint64(BITS) == asked >> np.uint64(BITS), j, before)
            known = c.keys[near] >> np.uint64(BITS) == asked >> np.uint64(BITS)
            value = np.where(hit, c.ratio[j], c.after[c.context[near]])
            found = known[of]
            ratio[at[found]] = value[of[found]]
            left = np.ones(n, bool)
            left[at[found]] = False
            open_ = open_[left[open_]]
            if not len(open_):
                break
        return per_text(ratio, sizes - 1) * np.minimum(1, LONG / (sizes - 1))

    def features(self, texts: pa.Array, memory: Memory) -> np.ndarray:
        """Two length-normalised comparisons for each text."""
        chunks, counts = ascii_words(pc.utf8_lower(texts))
        coded = chunks.dictionary_encode()
        if len(memory.slot) > self.max_words or memory.characters > self.max_characters:
            memory.clear()
        names = coded.dictionary.to_pylist()
        new = [x for x in names if x not in memory.slot]
        for start in range(0, len(new), 20_000):  # bounds the arrays of characters
            part = new[start:start + 20_000]
            parts = [WORDS.findall(x) for x in part]
            number: dict[str, int] = {}
            of = np.fromiter((number.setdefault(w, len(number)) for p in parts for w in p), np.int64)
            r, n = self.ratios(list(number))[of], np.fromiter(map(len, parts), np.int64, len(parts))
            values = np.column_stack([per_text(r, n), per_text(np.where(r > self.strong, r, 0), n), n])
            memory.add(part, values)
        slots = np.fromiter((memory.slot[x] for x in names), np.int64, len(names))
        per_chunk = memory.values[slots][np.asarray(coded.indices)] if len(chunks) else np.zeros((0, 3))
        total = np.stack([per_text(np.ascontiguousarray(per_chunk[:, k]), counts) for k in range(3)])
        return (total[:2] / np.maximum(total[2], 1)).T

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(_design(features) @ self.weights, -60, 60)))


def _mix(x: np.ndarray) -> np.ndarray:
    """Hashes 64-bit numbers one to one."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _design(features: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(features)), 10 * features[:, 0], np.log1p(100 * features[:, 1])])


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, x.T @ (weight * (p - y)) + ridge * w)
    return w


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", doc_id: str = "doc_id", max_docs: int = 4000,
        order: int = 6,
        settings: tuple[tuple[float, float], ...] = ((2.0, 3.0), (4.0, 4.0))) -> ToxicityModel:
    """Fits the models on ``max_docs`` texts of each class, or as many as the rarer class has; three quarters are counted, the rest calibrate.

    ``settings``: pairs of discount and ``strong``; the pair with the least
    log-loss on the calibration texts is taken.  Word counts are made by Spark;
    the driver gets the distinct words of the counted texts and the features of
    the calibration texts.
    """
    rank = F.xxhash64(F.col(doc_id))
    usable = labelled.where(F.col(label).isin(0, 1)).select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(label).cast("int").alias("toxic"), rank.alias("rank"))
    chosen = usable.select("doc_id", "toxic", "rank")
    share = {r["toxic"]: r["count"] for r in chosen.groupBy("toxic").count().collect()}  # two rows at most
    # as many of either class: with less counted text a model would find all that is new likelier than the other does
    n = min(max_docs, *(share.get(k, 0) for k in (0, 1)))
    picked = (chosen.where("toxic = 1").orderBy("rank", "doc_id").limit(n)
              .union(chosen.where("toxic = 0").orderBy("rank", "doc_id").limit(n))
              .select("doc_id").distinct())
    sample = usable.join(picked, "doc_id", "left_semi").withColumn("part", F.pmod(F.xxhash64("rank"), F.lit(4)))
    words = (sample.where("part > 0")
             .select("toxic", F.explode(F.array_distinct(F.regexp_extract_all(
                 F.lower(F.coalesce("text", F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0)))).alias("word"))
             .groupBy("word").agg(F.sum(1 - F.col("toxic")).alias("ordinary"), F.sum("toxic").alias("toxic"))
             .toArrow())
    by_class = np.stack([words[k].to_numpy() for k in ("ordinary", "toxic")]).astype(np.float32)
    best, least = _count([], np.zeros((2, 0)), order, *settings[0]), np.inf
    alphabet, grams = _grams(words["word"].to_pylist(), by_class, order)
    del words
    for discount, strong in settings if grams else ():
        model = _discounted(alphabet, grams, discount, strong)
        shared = labelled.sparkSession.sparkContext.broadcast(model.scorer())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memory = Memory()
            for batch in slices(batches):
                f = shared.value.features(batch.column(batch.schema.get_field_index("text")), memory)  # noqa: B023
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("toxic")), pa.array(f[:, 0]), pa.array(f[:, 1])], ["toxic", "a", "b"])

        held = sample.where("part = 0").select("text", "toxic").mapInArrow(run, "toxic int, a double, b double").toPandas()
        shared.destroy()
        if held["toxic"].nunique() < 2:
            continue
        x, y = _design(held[["a", "b"]].to_numpy()), held["toxic"].to_numpy()
        weight = np.array([share[k] / (y == k).sum() for k in (0, 1)])  # the classes as frequent as among all labels
        weight = (weight / weight.min())[y]
        model.weights, model.trained = logistic(x, y, weight), True
        z = np.clip(x @ model.weights, -30, 30)
        loss = float((weight * (np.log1p(np.exp(z)) - y * z)).sum())
        if loss < least:
            best, least = model, loss
    return best


def _count(words: list[str], counts: np.ndarray, order: int, discount: float, strong: float) -> ToxicityModel:
    """The n-gram counts of words with their class counts (ordinary, toxic)."""
    return _discounted(*_grams(words, counts, order), discount, strong)


Grams = tuple[np.ndarray, np.ndarray, np.ndarray]  # n-grams of one order; the same without their first character; class counts


def _grams(words: list[str], counts: np.ndarray, order: int, slice_words: int = 50_000) -> tuple[np.ndarray, list[Grams]]:
    """All characters of words, and the n-grams of each order with their numbers of documents; slices bound the memory."""
    alphabet = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), np.uint32))
    model, parts = ToxicityModel(alphabet, [], 0.0, 0.0), [[] for _ in range(order)]
    for start in range(0, len(words), slice_words):
        codes, sizes = model.codes(words[start:start + slice_words])
        weight = np.repeat(counts[:, start:start + slice_words], sizes - 1, axis=1)
        shorter = np.zeros(weight.shape[1], np.uint64)
        for part, (key, whole) in zip(parts, model.keys(codes, sizes, order)):
            part.append(_summed(key[whole], shorter[whole], weight[:, whole]))
            shorter = key
    merged = [_summed(*(np.concatenate(x, axis=-1) for x in zip(*p))) for p in parts if p]
    return alphabet, [m for m in merged if len(m[0])]


def _summed(keys: np.ndarray, shorter: np.ndarray, counts: np.ndarray) -> Grams:
    keys, at, of = np.unique(keys, return_index=True, return_inverse=True)
    return keys, shorter[at], np.stack([np.bincount(of, c, len(keys)) for c in counts]).astype(np.float32)


def _discounted(alphabet: np.ndarray, grams: list[Grams], discount: float, strong: float) -> ToxicityModel:
    model = ToxicityModel(alphabet, [], discount, strong)
    below = np.zeros(0)  # P(n-gram) by the shared model, of the order before
    for k, (keys, own_shorter, documents) in enumerate(grams):
        by_class, pooled = documents, documents.sum(0)
        if k + 1 < len(grams):
            _, shorter, longer = grams[k + 1]
            to = np.searchsorted(keys, shorter)
            left = np.bincount(to, minlength=len(keys))
            starts = left == 0  # begins a word: nothing can be before it
            pooled = np.where(starts, pooled, left).astype(np.float32)
            by_class = np.where(starts, by_class, np.stack([np.bincount(to, c > 0, len(keys)) for c in longer])).astype(np.float32)
        own = np.maximum(by_class - np.float32(discount), 0)
        contexts, of = np.unique(keys >> np.uint64(BITS), return_inverse=True)
        add = lambda v: np.bincount(of, v, len(contexts))  # noqa: B023, E731
        class_total = np.stack([add(c) for c in by_class])
        c = Counts(keys, pooled, own, contexts, add(pooled), add(np.ones(len(keys))), class_total, class_total - np.stack([add(o) for o in own]))
        model.orders.append(c)
        p = below[np.searchsorted(grams[k - 1][0], own_shorter)] if k else 1 / (len(alphabet) + 4)
        below = p = (np.maximum(pooled - 0.75, 0) + 0.75 * c.kinds[of] * p) / c.total[of]
        # the class models: own discounted counts, and the shared model for all the rest
        left = c.class_left + discount
        q = (own + left[:, of] * p) / (class_total[:, of] + discount) + model.common * p
        r = left / (class_total + discount) + model.common
        model.tables.append(Ratios(keys, np.log(q[1] / q[0]), of.astype(np.int32), np.log(r[1] / r[0])))
    return model


def shipped(model: ToxicityModel, spark: SparkSession) -> Broadcast:
    """What the tasks need of the model.  Nothing that fitting has held on the driver is held on."""
    shared = spark.sparkContext.broadcast(model.scorer())
    give_back()
    return shared


def toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """The columns of ``docs`` without the text, and ``score``, 0 to 1."""
    shared = shipped(model, docs.sparkSession)
    rest = docs.drop("score")
    kept = [f for f in rest.schema if f.name != text]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory()
        for batch in slices(batches, text, SLICE_BYTES // 4):
            value = shared.value.score(shared.value.features(batch.column(batch.schema.get_field_index(text)), memory))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(value)], [*names, "score"])

    return rest.mapInArrow(run, with_fields(kept, "score double"))


def score(text: Column, model: ToxicityModel, spark: SparkSession) -> Column:
    """The scores of a text column; Python gets the texts alone and returns numbers, so rows are neither copied nor stored."""
    shared = shipped(model, spark)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        memory = Memory()
        for column in columns:
            batch = pa.RecordBatch.from_arrays([column], ["text"])
            parts = [shared.value.score(shared.value.features(x.column(0), memory)) for x in slices([batch], max_bytes=SLICE_BYTES // 4)]
            yield pa.array(np.concatenate([*parts, np.zeros(0)]))

    return F.arrow_udf(run, "double")(text)


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with a label, but for the held-out fifth."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(F.col("doc_id"), 5) != 0)
    return documents(spark, sf_dir).where(fold(F.col("doc_id"), 5) != 0).join(labels, "doc_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(documents(spark, sf_dir), fit(labelled_texts(spark, sf_dir)))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
