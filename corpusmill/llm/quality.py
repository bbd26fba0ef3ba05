"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer numpy network.

Words are hashed to a fixed number of rows. Each row has a sparse ternary index vector; its context vector is the sum of
the index vectors of its neighbours in the training texts. A word counts as itself and as its shape (letter case and
symbols). A document is the mean of its words' index and context vectors, with the mean vector's length, the share of
words that repeat their neighbour, that of distinct words, and the text's length. The network's output is calibrated by a
temperature fitted on rows that training left aside.

Only text enters a score. The fit takes at most ``most`` labelled rows, those of smallest hashed key; that bound is its
only limit on data, and scoring reads all rows and whole texts.

Edge cases: null and empty texts are pooled to zero vectors and scored like any other; repeated rows are scored alike; an
empty training table gives score 0.5 for all rows; only one label in it, a score near that label.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.session import share_code

EXTRAS = 5
_CAPITALS, _LETTERS, _DIGITS = regex.compile(r"\p{Lu}+"), regex.compile(r"[\p{L}--A]+", regex.V1), regex.compile(r"\p{N}+")


def shape(word: str) -> str:
    """Runs of capitals, other letters and digits become A, a and 9."""
    return _DIGITS.sub("9", _LETTERS.sub("a", _CAPITALS.sub("A", word)))


@dataclass
class Model:
    vectors: np.ndarray  # one row per hashed word: index vector, context vector
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def rows_of(distinct: list[str], size: int) -> np.ndarray:
    """Two rows for each string: of the word, and of its shape."""
    return np.array([(zlib.crc32(w.lower().encode()) % size, zlib.crc32(b"\0" + shape(w).encode()) % size) for w in distinct], np.int64).reshape(-1, 2)


def pool(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row of features per text."""
    size, dim = vectors.shape
    bounds, index, distinct = W.split_words(W.mapped(texts, W.SPACES))
    rows = rows_of(distinct.to_pylist(), size)
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    out = np.zeros((len(n), dim + EXTRAS))
    step = max(1, (1 << 20) // size)
    for a in range(0, len(n), step):
        b = min(len(n), a + step)
        part = slice(bounds[a], bounds[b])
        counts = np.zeros((b - a) * size, np.float32)
        for j in (0, 1):
            counts += np.bincount((owner[part] - a) * size + rows[index[part], j], minlength=len(counts)).astype(np.float32)
        out[a:b, :dim] = counts.reshape(b - a, size) @ vectors
    some = np.maximum(n, 1)
    out[:, :dim] /= 2 * some[:, None]
    again = np.concatenate([[False], (index[1:] == index[:-1]) & (owner[1:] == owner[:-1])]) if len(index) else np.zeros(0, bool)
    pairs = np.unique(owner * max(1, len(distinct)) + index) if len(index) else np.zeros(0, np.int64)
    out[:, dim] = np.linalg.norm(out[:, :dim], axis=1)
    out[:, dim + 1] = W.sums(again.astype(np.int64), bounds) / some
    out[:, dim + 2] = np.bincount(pairs // max(1, len(distinct)), minlength=len(n))[: len(n)] / some
    out[:, dim + 3] = np.log1p(n)
    out[:, dim + 4] = np.log1p(pc.binary_length(texts).to_numpy(zero_copy_only=False) / some)
    return out


def word_vectors(texts: pa.Array, size: int, dim: int, window: int, seed: int) -> np.ndarray:
    """Random indexing over the texts: unit index vectors beside unit context vectors."""
    rng = np.random.default_rng(seed)
    plain = np.zeros((size, dim), np.float32)
    for r, row in enumerate(rng.permuted(np.tile(np.arange(dim), (size, 1)), axis=1)[:, :4]):
        plain[r, row] = (1, 1, -1, -1)
    bounds, index, distinct = W.split_words(W.mapped(texts, W.SPACES))
    context = np.zeros((size, dim), np.float32)
    if len(index):
        rows = rows_of(distinct.to_pylist(), size)[index]
        owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for gap in range(1, window + 1):
            near = owner[gap:] == owner[:-gap]
            left, right = rows[:-gap][near], rows[gap:][near]
            for here, there in ((left, right), (right, left)):
                for i, j in ((0, 1), (1, 1)):
                    pair, count = np.unique(here[:, i] * size + there[:, j], return_counts=True)
                    for a in range(0, len(pair), 1 << 16):  # a portion at a time: the driver's memory is small
                        part, n = pair[a : a + (1 << 16)], count[a : a + (1 << 16), None]
                        np.add.at(context, part // size, plain[part % size] * n.astype(np.float32))
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    return np.concatenate([plain / 2, context / np.maximum(norm, 1e-9)], axis=1)


def train(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int, epochs: int, seed: int) -> Model:
    """Adam on the log loss with weight decay; every fifth row only calibrates the temperature."""
    rng = np.random.default_rng(seed)
    d = x.shape[1]
    model = Model(vectors, np.zeros(d), np.ones(d), rng.normal(0, d**-0.5, (d, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0, 1.0)
    if not len(y):
        return model
    aside = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
    model.mean, model.scale = x[~aside].mean(0), x[~aside].std(0) + 1e-3
    xs, ys = (x[~aside] - model.mean) / model.scale, y[~aside].astype(float)
    weights = [model.w1, model.b1, rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for t in range(1, epochs + 1):
        w1, b1, w2, b2 = weights
        h = np.tanh(xs @ w1 + b1)
        error = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30))) - ys) / len(ys)
        back = np.outer(error, w2) * (1 - h * h)
        for i, g in enumerate((xs.T @ back + 1e-3 * w1, back.sum(0), h.T @ error + 1e-3 * w2, error.sum(keepdims=True))):
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            weights[i] = weights[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    model.w1, model.b1, model.w2, model.b2 = weights[0], weights[1], weights[2], float(weights[3][0])
    if aside.any():
        z, target = model.logits(x[aside]), y[aside]
        soft = np.where(target == 1, (target.sum() + 1) / (target.sum() + 2), 1 / (len(target) - target.sum() + 2))
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.mean(soft * np.logaddexp(0, -z / t) + (1 - soft) * np.logaddexp(0, z / t)) for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality", key: str = "doc_id", most: int = 3000, size: int = 1 << 13, dim: int = 48, window: int = 2, hidden: int = 24, epochs: int = 300, seed: int = 7) -> Model:
    """A model from at most ``most`` rows of ``labels`` (key, label; not null), joined to their texts."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("__y"))
    chosen = known.orderBy(F.xxhash64(key), key).limit(most)
    rows = docs.select(key, F.col(text).alias("__text")).join(F.broadcast(chosen), key).groupBy(key).agg(F.min_by("__text", F.xxhash64("__text")).alias("__text"), F.first("__y").alias("__y")).orderBy(F.xxhash64(key), key).select("__text", "__y").toArrow()
    texts = pc.fill_null(rows.column(0).combine_chunks().cast(pa.large_string()), "")
    vectors = word_vectors(texts, size, dim, window, seed)
    model = train(pool(texts, vectors), rows.column(1).to_numpy().astype(int), vectors, hidden, epochs, seed)
    del rows, texts
    W.trim()  # the driver's memory is small
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus score: the calibrated probability of label 1."""
    spark = docs.sparkSession
    share_code(spark)
    held = spark.sparkContext.broadcast(model)
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    names = chosen.columns[:-1]
    out = W.schema(docs.select(*keep), "score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in W.slices(batches, "__text"):
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(model.score(pool(W.texts_of(batch, "__text"), model.vectors)))], names=[*names, "score"])

    return chosen.mapInArrow(run, out)
