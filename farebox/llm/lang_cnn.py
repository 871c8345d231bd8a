"""Language identification by a byte convolutional network (operator 6).

Bytes are embedded; filters of several widths slide over a window of fixed
length; the maximum of each filter over the window goes through a softmax.  The
network is trained in numpy on windows of a bounded sample of labelled texts
and is a few kilobytes, so it is broadcast.  A text is cut into windows that
follow one another to its end; the mean of the windows' log-probabilities,
weighted by their bytes, gives its language.

To apply a trained filter, embedding and filter are multiplied beforehand: what
a pair of bytes adds to a filter's sum is a row of a table, so a window costs a
few look-ups a byte.

Cases.  Null texts and texts without a letter are 'und' with score 0, as is
every text when there is nothing to learn from.  Of languages equally likely
the first in order wins.  Rows without a language are not learnt from.  Repeated
rows are judged each for itself; a long text has many windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import byte_lengths, fold, per_text, slices, string_array, table, with_fields

WINDOW = 256
WIDTHS = (2, 3, 4)


@dataclass
class ByteCNN:
    languages: list[str]
    embedding: np.ndarray  # 256 x e
    filters: list[np.ndarray]  # for each width: width x e x f
    bias: list[np.ndarray]
    dense: np.ndarray  # all filters x languages
    offset: np.ndarray

    @classmethod
    def new(cls, languages: list[str], size: int = 8, filters: int = 16, seed: int = 7) -> ByteCNN:
        r = np.random.default_rng(seed)
        draw = lambda *shape, scale: (r.standard_normal(shape) * scale).astype(np.float32)
        return cls(languages, draw(256, size, scale=0.5), [draw(w, size, filters, scale=(1 / (w * size)) ** 0.5) for w in WIDTHS],
                   [np.zeros(filters, np.float32) for _ in WIDTHS],
                   draw(filters * len(WIDTHS), len(languages), scale=0.2), np.zeros(len(languages), np.float32))

    # -- training

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.bias, self.dense, self.offset]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross-entropy over a batch of windows (n x length, bytes)."""
        n, rows = len(x), np.arange(len(x))[:, None]
        seen = self.embedding[x]
        pooled, places = [], []
        for w, k, b in zip(WIDTHS, self.filters, self.bias):
            out = sum(seen[:, j:x.shape[1] - w + 1 + j] @ k[j] for j in range(w)) + b
            place = out.argmax(1)
            pooled.append(np.take_along_axis(out, place[:, None], 1)[:, 0])
            places.append(place)
        raw = np.concatenate(pooled, 1)
        hidden = np.maximum(raw, 0)
        delta = softmax(hidden @ self.dense + self.offset)
        delta[np.arange(n), y] -= 1
        delta /= n
        back = (delta @ self.dense.T) * (raw > 0)
        g_embedding, g_filters, g_bias = np.zeros_like(self.embedding), [], []
        for (w, k), place, d in zip(zip(WIDTHS, self.filters), places, np.split(back, len(WIDTHS), 1)):
            g = np.zeros_like(k)
            for j in range(w):
                byte = x[rows, place + j]  # n x f: the byte under each filter's best place
                g[j] = np.einsum("nfe,nf->ef", self.embedding[byte], d)
                np.add.at(g_embedding, byte.ravel(), (d[:, :, None] * k[j].T[None]).reshape(-1, k.shape[1]))
            g_filters.append(g)
            g_bias.append(d.sum(0))
        return [g_embedding, *g_filters, *g_bias, hidden.T @ delta, delta.sum(0)]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 3e-3, seed: int = 7) -> None:
        """Adam; in every epoch a third of the windows are cut short, as short texts are."""
        r = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for a in range(0, len(order), batch):
                some = order[a:a + batch]
                windows = x[some].copy()
                for i in np.flatnonzero(r.random(len(some)) < 1 / 3):
                    windows[i, r.integers(8, WINDOW):] = 0
                step += 1
                for p, g, m, v in zip(self.parameters(), self.gradients(windows, y[some]), first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    # -- use

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width: (offset, what the byte pair, or the byte, at that offset adds to each filter)."""
        out = []
        for w, k in zip(WIDTHS, self.filters):
            one = [self.embedding @ k[j] for j in range(w)]
            parts = [(j, (one[j][:, None] + one[j + 1][None]).reshape(65536, -1)) for j in range(0, w - 1, 2)]
            out.append(parts + ([(w - 1, one[-1])] if w % 2 else []))
        return out

    def log_probabilities(self, x: np.ndarray, tables: list, batch: int = 128) -> np.ndarray:
        """Of each window (n x WINDOW bytes)."""
        out = np.empty((len(x), len(self.languages)), np.float32)
        for a in range(0, len(x), batch):
            part = x[a:a + batch]
            pairs = part[:, :-1].astype(np.int32) * 256 + part[:, 1:]
            pooled = []
            for w, b, parts in zip(WIDTHS, self.bias, tables):
                n, total = WINDOW - w + 1, None
                for at, t in parts:
                    add = t[pairs[:, at:at + n]] if len(t) == 65536 else t[part[:, at:at + n]]
                    total = add if total is None else np.add(total, add, out=total)
                pooled.append(total.max(1) + b)
            z = np.maximum(np.concatenate(pooled, 1), 0) @ self.dense + self.offset
            out[a:a + batch] = np.log(softmax(z) + 1e-9)
        return out


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def windows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All windows of all texts (padded with 0) and the number of windows of each text."""
    sizes = byte_lengths(texts)
    n = -(-sizes // WINDOW)
    data = np.frombuffer(b"".join(pc.cast(texts, pa.binary()).to_pylist()), np.uint8)
    padded = n * WINDOW
    out = np.zeros(int(padded.sum()), np.uint8)
    starts = np.cumsum(padded) - padded
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out[np.arange(len(data)) + shift] = data
    return out.reshape(-1, WINDOW), n


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = 400,
        max_windows: int = 6) -> ByteCNN | None:
    """Trains on at most ``max_windows`` windows, spread evenly, of at most ``max_docs`` texts of each language."""
    usable = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(doc_id).alias("rank"), F.col(doc_id).alias("doc_id"))
    # in two steps, each of which Spark limits before its shuffle: a frequent language's texts never meet in one task
    ranked = usable.select("lang", "rank", "doc_id").withColumn("part", F.pmod("rank", F.lit(64)))
    for parts in (("lang", "part"), ("lang",)):
        order = Window.partitionBy(*parts).orderBy("rank", "doc_id")
        ranked = ranked.withColumn("at", F.row_number().over(order)).where(F.col("at") <= max_docs).drop("at")
    picked = ranked.select("doc_id", "lang").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x, n = windows(string_array(batch.column(batch.schema.get_field_index("text"))))
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            names, raw, start = [], [], 0
            for name, k in zip(langs, n.tolist()):
                for i in np.unique(np.linspace(0, k - 1, min(k, max_windows)).astype(int)):
                    names.append(name)
                    raw.append(x[start + i].tobytes())
                start += k
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(raw, pa.binary())], ["lang", "window"])

    sample = (usable.drop("rank").join(picked, ["doc_id", "lang"], "left_semi").select("lang", "text")
              .mapInArrow(run, "lang string, window binary").orderBy("lang", "window").toPandas())
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    model = ByteCNN.new(languages)
    x = np.frombuffer(b"".join(map(bytes, sample["window"])), np.uint8).reshape(-1, WINDOW)
    model.train(x, np.array([languages.index(v) for v in sample["lang"]]))
    return model


def identify(docs: DataFrame, model: ByteCNN | None, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but the text, with lang_pred and score."""
    rest = docs.drop("lang_pred", "score")
    kept = [f for f in rest.schema if f.name != text]
    names = [f.name for f in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        tables = net.tables() if net else None
        for batch in slices(batches, text):
            texts = string_array(batch.column(batch.schema.get_field_index(text)))
            judged = np.asarray(pc.match_substring_regex(texts, r"\pL"))
            lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            if net and judged.any():
                some = texts.filter(pa.array(judged))
                x, n = windows(some)
                used = byte_lengths(some)
                weight = np.full(len(x), WINDOW, np.float64)
                weight[np.cumsum(n) - 1] = used - (n - 1) * WINDOW
                logs = net.log_probabilities(x, tables) * weight[:, None]
                mean = np.stack([per_text(np.ascontiguousarray(logs[:, k]), n) for k in range(logs.shape[1])], 1) / used[:, None]
                p = softmax(mean)
                best = p.argmax(1)
                lang[judged] = np.array(net.languages, object)[best]
                score[judged] = p[np.arange(len(p)), best]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in names),
                                              pa.array(lang, pa.string()), pa.array(score)], [*names, "lang_pred", "score"])

    return rest.mapInArrow(run, with_fields(kept, "lang_pred string, score double"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 5) == 0
    return (identify(docs.select("doc_id", "text"), fit(docs.where(~held_out)))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))
