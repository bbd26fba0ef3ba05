"""Language ID by language-bitmask n-gram filters.

A bit-sliced Bloom filter keeps, for each bit position, a bit per language, in as many machine words as the languages take.
The AND of the words at an n-gram's positions is the set of all languages that (appear to) contain it. Per language, the hits
are counted and corrected for that language's false-positive rate; the language with the largest corrected share decides.

Every language of the training rows has a bit. Each language's filter is made in a task of its own; the driver gets filters
of fixed size only.

Edge cases: null, empty and letterless texts give ``und`` with score 0; equal shares go to the language first in sorted
order; repeated rows are judged row by row; whole texts are read, in slices of bounded bytes, a very long single word like any
other; an empty or unlabelled training table gives ``und`` for all rows, and an empty table an empty result; extra columns are
ignored unless named in ``keep``, and one that is named like an output is refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.session import share_code

UNKNOWN = "und"
_LETTERS = regex.compile(r"\p{L}+")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@dataclass
class Filters:
    """``slices[p]``: the languages whose filter has bit p set, 64 to a word; ``rates``: false positives of each language."""

    languages: list[str]
    slices: np.ndarray
    rates: np.ndarray
    sizes: tuple[int, ...]
    hashes: int

    def find(self, grams: np.ndarray) -> np.ndarray:
        """The language bitmask of each n-gram hash, a row of words."""
        found = np.full((len(grams), self.slices.shape[1]), np.uint64(0xFFFFFFFFFFFFFFFF))
        for at in positions(grams, len(self.slices), self.hashes):
            found &= self.slices[at]
        return found


def positions(grams: np.ndarray, width: int, hashes: int) -> Iterator[np.ndarray]:
    for m in _MULTIPLIERS[:hashes]:
        x = grams * m
        yield ((x ^ (x >> np.uint64(29))) * _MULTIPLIERS[-1] >> np.uint64(20)) & np.uint64(width - 1)


def word_grams(distinct: list[str], sizes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, bounds, letters): the n-grams of each string's lower-cased letter runs, edges marked by a blank."""
    marked = [f" {'  '.join(_LETTERS.findall(s.lower()))} " for s in distinct]
    letters = np.fromiter((len(m) > 2 for m in marked), bool, len(marked))
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    owner = np.repeat(np.arange(len(marked)), length)
    hashes, owners = [], []
    for n in sizes:
        if len(code) < n:
            continue
        m = len(code) - n + 1
        h = np.full(m, np.uint64(n))
        blanks = np.zeros(m, np.int8)
        for k in range(n):
            part = code[k : k + m]
            h = (h ^ part) * np.uint64(0x100000001B3) + (h >> np.uint64(41))
            blanks += (part == 32) & (0 < k < n - 1)
        use = (owner[:m] == owner[n - 1 :]) & (blanks == 0)
        if n <= 2:  # blanks alone are no n-gram
            use &= ~((code[:m] == 32) & (code[n - 1 :] == 32))
        hashes.append(h[use])
        owners.append(owner[:m][use])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(marked) + 1, np.int64), letters
    owners_all = np.concatenate(owners)
    order = np.argsort(owners_all, kind="stable")
    return np.concatenate(hashes)[order], np.concatenate([[0], np.cumsum(np.bincount(owners_all, minlength=len(marked)))]), letters


def gram_counts(distinct: list[str], n: np.ndarray, sizes: tuple[int, ...], portion: int = 1 << 13) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, how often they occur) in strings that occur n times each."""
    grams, total = np.zeros(0, np.uint64), np.zeros(0)
    for at in range(0, len(distinct), portion):
        own, bounds, _ = word_grams(distinct[at : at + portion], sizes)
        weight = np.repeat(n[at : at + portion].astype(float), np.diff(bounds))
        grams, inverse = np.unique(np.concatenate([grams, own]), return_inverse=True)
        total = np.bincount(inverse, np.concatenate([total, weight]), len(grams)) if len(grams) else total
    return grams, total


def fit(train: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", docs_per_language: int = 400, sizes: tuple[int, ...] = (1, 2, 3, 4), width: int = 1 << 21, hashes: int = 3, least: float = 2e-5, most_languages: int = 4096) -> Filters:
    """Filters from at most about ``docs_per_language`` labelled rows of each language, those of smallest hashed ``key``.

    An n-gram belongs to a language if it makes up ``least`` of that language's n-grams and occurs twice. The filters take
    64 MB at most: up to 256 languages have ``width`` positions, more have fewer. More than ``most_languages`` values are
    taken for a column that holds something else, and refused.
    """
    spark = train.sparkSession
    share_code(spark)
    rows = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r[0]: r[1] for r in rows.groupBy(lang).count().limit(most_languages + 1).collect()}
    if len(counts) > most_languages:
        raise ValueError(f"{lang} has more than {most_languages} values")
    languages = sorted(counts)
    words = max(1, -(-len(languages) // 64))
    width = min(width, 1 << int(math.log2((1 << 23) / words)))
    slices, rates = np.zeros((width, words), np.uint64), np.zeros(max(1, len(languages)))
    if not languages:
        return Filters(languages, slices, rates, sizes, hashes)
    cuts = spark.createDataFrame([(n, int(min(1.0, docs_per_language / counts[n]) * (1 << 30))) for n in languages], "__lang string, __cut long")
    sample = rows.select(F.col(lang).alias("__lang"), F.col(text).alias("__text"), F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)).alias("__at")).join(F.broadcast(cuts), "__lang").where("__at < __cut")
    pieces = sample.select("__lang", F.explode(F.split("__text", r"\s+")).alias("w")).groupBy("__lang", "w").agg(F.count("*").alias("n"))

    def filters(own: pa.Table) -> pa.Table:
        grams, total = gram_counts(own.column("w").to_pylist(), own.column("n").to_numpy(), sizes)
        bits = np.zeros(width, bool)
        for at in positions(grams[(total >= 2) & (total >= least * total.sum())], width, hashes):
            bits[at] = True
        return pa.table({"lang": own.column("__lang")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

    for name, packed in pieces.groupBy("__lang").applyInArrow(filters, "lang string, bits binary").toLocalIterator():
        i, bits = languages.index(name), np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").astype(np.uint64)
        slices[:, i // 64] |= bits << np.uint64(i % 64)
        rates[i] = bits.mean() ** hashes
    W.trim()
    return Filters(languages, slices, rates, sizes, hashes)


def word_scores(model: Filters, distinct: list[str], portion: int = 1 << 12) -> np.ndarray:
    """One row per string: hits of each language, then n-grams, then 1 if there is a letter."""
    k = len(model.languages)
    out = np.zeros((len(distinct), k + 2))
    for at in range(0, len(distinct), portion):
        part = slice(at, min(len(distinct), at + portion))
        grams, bounds, letters = word_grams(distinct[part], model.sizes)
        found = model.find(grams)
        for i in range(k):
            out[part, i] = W.sums(((found[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64), bounds)
        out[part, k] = np.diff(bounds)
        out[part, k + 1] = letters
    return out


def predict(docs: DataFrame, model: Filters, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",), known: bool = False) -> DataFrame:
    """``keep`` columns plus lang_pred and score: the best corrected share over the sum of the two best, 0 to 1. With
    ``known`` also that best share itself: how much of the text's n-grams the language has."""
    spark = docs.sparkSession
    share_code(spark)
    held = spark.sparkContext.broadcast(model)
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    names = chosen.columns[:-1]
    out = W.schema(docs.select(*keep), "lang_pred string, score double" + ", known double" * known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        k = len(model.languages)
        for batch in W.slices(batches, "__text"):
            bounds, index, distinct = W.split_words(W.mapped(W.texts_of(batch, "__text"), W.SPACES))
            per = word_scores(model, distinct.to_pylist())
            total = np.stack([W.sums(per[index, j], bounds) for j in range(k + 2)], axis=1)
            pred, score, held_share = np.full(len(total), UNKNOWN, object), np.zeros(len(total)), np.zeros(len(total))
            if k:
                share = np.clip((total[:, :k] - model.rates * total[:, k : k + 1]) / (1 - np.minimum(model.rates, 0.999)) / np.maximum(total[:, k : k + 1], 1), 0, 1)
                best = share.argmax(axis=1)
                top = share[np.arange(len(share)), best]
                second = np.partition(share, -2, axis=1)[:, -2] if k > 1 else np.zeros(len(share))
                some = (total[:, k + 1] > 0) & (total[:, k] > 0)
                pred[some] = np.array(model.languages, object)[best[some]]
                held_share[some] = top[some]
                score[some] = np.where(top[some] > 0, top[some] / np.maximum(top[some] + second[some], 1e-12), 0)
            made = [pa.array(pred, pa.string()), pa.array(score), pa.array(held_share)][: 2 + known]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *made], names=[*names, "lang_pred", "score", "known"][: len(names) + 2 + known])

    return chosen.mapInArrow(run, out)
