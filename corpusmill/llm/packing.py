"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two: as many of the longest length as fit, then the
binary digits of the rest, longest first. Each piece is a sequence of its own, so no sequence crosses documents and none
needs padding; ``bucket`` (log2 of the length) groups the sequences of equal length for batching.

Sequence ids are the task's partition number and a counter in it: unique for repeated rows too, and the same when a lost
task runs again, since partitions are read in a fixed order. No shuffle is needed.

Ids are those of the tokenizer's plain ``encode`` without added special tokens: the string of a special token in a text is
that token, as there.

Edge cases: a null or empty text is the end id alone, one piece of length 1; very long texts give as many longest pieces
as they need; rows with a null or repeated key are packed row by row, equal texts into equal pieces; an empty table gives no
pieces; other columns are carried only if named in ``keep``, and one that is named like an output is refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.session import share_code


#: A run of letters, then a run of marks: two pre-tokens whatever they are, so they are encoded and remembered apart.
_PLAIN = "^(?P<head>[a-z\u00df-\u00f6\u00f8-\u00ff]+)(?P<tail>[.,;:!?&%$#*|]+)$"


class WordTokenizer:
    """A tokenizer whose model drops white space, so that texts can be cut there and equal words encoded once.

    ASCII capitals are lowered before words are compared, which the tokenizer does anyway. Ids of words are kept, one after
    another, in one array; when the words have more than ``held`` bytes of text, those used least go. Texts with the string of
    a special token are encoded whole.
    """

    def __init__(self, path: str, held: int = 2 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = sorted({t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content})
        self.most = held
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.bytes = 0
        self.flat, self.end, self.uses = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, np.int64)

    def _thin(self) -> None:
        """Keeps the words that were used most, half the bytes at most; none that was used once."""
        words, size = list(self.place), np.fromiter(map(len, self.place), np.int64, len(self.place))
        order = np.argsort(-self.uses, kind="stable")
        kept = np.sort(order[(np.cumsum(size[order]) <= self.most // 2) & (self.uses[order] > 1)])
        length = np.diff(self.end)[kept]
        self.flat, self.end = self.flat[W.ragged(self.end[kept], length)], np.concatenate([[0], np.cumsum(length)])
        self.place, self.bytes, self.uses = {words[i]: n for n, i in enumerate(kept.tolist())}, int(size[kept].sum()), self.uses[kept] // 2

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where each of the distinct words' ids are kept."""
        names = words.to_pylist()
        if self.bytes > self.most:
            self._thin()
        place, encode = self.place, self.tokenizer.encode
        new = [w for w in dict.fromkeys(names) if w not in place]  # a word may be both a head and a tail
        if new:
            ids = [encode(w, add_special_tokens=False).ids for w in new]
            self.bytes += sum(map(len, new))
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            length = np.fromiter(map(len, ids), np.int64, len(ids))
            self.flat = np.concatenate([self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(length.sum()))])
            self.end = np.concatenate([self.end, self.end[-1] + np.cumsum(length)])
            self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])
        at = np.fromiter(map(place.__getitem__, names), np.int64, len(names))
        self.uses[at] += 1
        return at

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of whole texts."""
        lowered = W.mapped(texts, W.SPACES_LOWER)
        odd = np.zeros(len(texts), bool)
        for token in self.special:
            odd |= pc.match_substring(lowered, token).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self._encode(lowered)
        ids, bounds = self._encode(pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), lowered))
        own = [self.tokenizer.encode(t, add_special_tokens=False).ids for t in texts.filter(pa.array(odd)).to_pylist()]
        more = np.zeros(len(texts), np.int64)
        more[odd] = list(map(len, own))
        ids = np.insert(ids, np.repeat(bounds[:-1][odd], more[odd]), np.fromiter(chain.from_iterable(own), np.uint32, int(more.sum())))
        return ids, bounds + np.concatenate([[0], np.cumsum(more)])

    def _encode(self, lowered: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        bounds, index, distinct = W.split_words(lowered)
        parts = pc.extract_regex(distinct, _PLAIN)
        heads = pc.coalesce(pc.struct_field(parts, "head"), distinct).dictionary_encode()
        tails = pc.fill_null(pc.struct_field(parts, "tail"), "").dictionary_encode()
        both = self._places(pa.concat_arrays([heads.dictionary, tails.dictionary]))
        head = both[: len(heads.dictionary)][heads.indices.to_numpy()]
        tail = both[len(heads.dictionary) :][tails.indices.to_numpy()]
        spans = np.stack([head, tail], axis=1)[index].ravel()
        length = np.diff(self.end)[spans]
        return self.flat[W.ragged(self.end[spans], length)], np.concatenate([[0], np.cumsum(length)])[2 * bounds]


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer per vocabulary and Python worker."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def decompose(n: int, longest: int) -> list[int]:
    """Lengths, powers of two of at most ``longest``, that add up to n, longest first."""
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if n % longest >> b & 1]


def pack(docs: DataFrame, path: str, longest: int = 2048, end_id: int = 1, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """One row per piece: ``keep`` columns, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id,
    offset, bucket. ``longest`` is a power of two; every document ends with ``end_id``."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    share_code(docs.sparkSession)
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    names = chosen.columns[:-1]
    out = W.schema(docs.select(*keep), "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, bucket int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, next_id = tokenizer(path), TaskContext.get().partitionId() << 40
        for batch in W.slices(batches, "__text", 1 << 20):
            ids, bounds = own.encode(W.texts_of(batch, "__text"))
            n = np.diff(bounds) + 1
            ends = np.cumsum(n)
            flat = np.full(int(ends[-1]), end_id, "<u4")
            mask = np.ones(len(flat), bool)
            mask[ends - 1] = False
            flat[mask] = ids
            cuts = [decompose(k, longest) for k in n.tolist()]
            length = np.fromiter((x for c in cuts for x in c), np.int64)
            owner = np.repeat(np.arange(len(n)), np.fromiter(map(len, cuts), np.int64))
            begin = np.cumsum(length) - length
            pieces = pa.Array.from_buffers(pa.binary(), len(length), [None, pa.py_buffer((np.concatenate([begin, ends[-1:]]) * 4).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(at) for c in names), pa.array(begin - (ends - n)[owner]), pa.array(length), pieces, pa.array(n[owner]), pa.array(next_id + np.arange(len(length))), pa.array(np.zeros(len(length), np.int64)), pa.array(np.log2(length).astype(np.int32))],
                names=[f.name for f in out.fields],
            )
            next_id += len(length)

    return chosen.mapInArrow(run, out)
