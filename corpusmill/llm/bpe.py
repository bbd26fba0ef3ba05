"""Byte-level BPE through a sentencepiece model that is serialised directly from the rank vocabulary.

Each byte is mapped to a printable character; a token becomes the piece of its bytes' characters with score ``-rank``;
normalisation is the identity. Sentencepiece then merges, best score first and leftmost among equals, just as merging by
lowest rank does. Pre-tokens are encoded one by one (one that is a token as a whole is that token); decoding maps ids
back to bytes.

Edge cases: null and empty texts have no tokens; whole texts are encoded, in slices of bounded bytes; texts are any
Unicode; repeated rows are encoded row by row.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.session import share_code


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it is printable Latin-1, else one from U+0100 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def _field(number: int, kind: int, payload: bytes) -> bytes:
    return _varint(number << 3 | kind) + (payload if kind != 2 else _varint(len(payload)) + payload)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece ModelProto (protobuf wire format): piece 0 is unknown, piece ``rank + 1`` the token of that rank."""
    chars = byte_characters()
    names: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        names[rank] = token
    out = [_field(1, 2, _field(1, 2, b"<unk>") + _field(2, 5, np.float32(0).tobytes()) + _field(3, 0, _varint(2)))]
    for rank, token in enumerate(names):
        text = f"\x01unused{rank}" if token is None else "".join(chars[b] for b in token)
        kind = _field(3, 0, _varint(5)) if token is None else b""  # 5: unused
        out.append(_field(1, 2, _field(1, 2, text.encode()) + _field(2, 5, np.float32(-rank).tobytes()) + kind))
    minus_one = _varint((1 << 64) - 1)
    trainer = _field(3, 0, _varint(2)) + _field(4, 0, _varint(len(names) + 1)) + _field(40, 0, _varint(0)) + b"".join(_field(i, 0, minus_one) for i in (41, 42, 43))  # BPE; unk 0; no bos, eos, pad
    plain = _field(1, 2, b"identity") + _field(3, 0, b"\0") + _field(4, 0, b"\0") + _field(5, 0, b"\0")  # no dummy prefix, white space as it is
    return b"".join([*out, _field(2, 2, trainer), _field(3, 2, plain)])


class Codec:
    """Encoder and decoder of one vocabulary file; ``held`` bounds the strings whose encodings are remembered."""

    def __init__(self, path: str, pattern: str, held: int = 250_000):
        import sentencepiece

        self.ranks = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.model = sentencepiece.SentencePieceProcessor()
        self.model.LoadFromSerializedProto(serialise(self.ranks))
        chars = byte_characters()
        self.to_chars = {b: c for b, c in enumerate(chars)}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_length = np.fromiter(map(len, tokens), np.int64, size)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.held: dict[str, np.ndarray] = {}
        self.most = held

    def encode_pretokens(self, pretokens: list[str]) -> list[list[int]]:
        """Ids of each pre-token."""
        raw = [p.encode("utf-8") for p in pretokens]
        whole = [self.ranks.get(b) for b in raw]
        rest = [i for i, r in enumerate(whole) if r is None]
        spelled = self.model.encode([raw[i].decode("latin-1").translate(self.to_chars) for i in rest], num_threads=1) if rest else []
        out = [[r] for r in whole]
        for i, ids in zip(rest, spelled, strict=True):
            out[i] = [x - 1 for x in ids]
        return out

    def encode_strings(self, strings: list[str]) -> list[np.ndarray]:
        """Ids of each string, each cut by the pattern on its own."""
        new = list(dict.fromkeys(s for s in strings if s not in self.held))
        if len(self.held) + len(new) > self.most:
            self.held.clear()
            new = list(dict.fromkeys(strings))
        parts = [self.pattern.findall(s) for s in new]
        flat = list(dict.fromkeys(p for x in parts for p in x))
        ids = dict(zip(flat, self.encode_pretokens(flat), strict=True))
        for s, x in zip(new, parts, strict=True):
            self.held[s] = np.array([i for p in x for i in ids[p]], np.int32)
        return [self.held[s] for s in strings]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of whole texts.

        The pattern always begins a pre-token at a single space between two characters that are not white space, so
        texts made only of such words are cut there and equal pieces are encoded once. Other texts go whole.
        """
        bounds, index, distinct = W.split_words(texts, keep_empty=True)
        names = distinct.to_pylist()
        plain = np.fromiter((bool(s) and not s[0].isspace() and not s[-1].isspace() for s in names), bool, len(names))
        simple = W.sums((~plain[index]).astype(np.int64), bounds) == 0
        n_words = np.diff(bounds)
        first = np.zeros(len(index), bool)
        first[bounds[:-1][n_words > 0]] = True
        use = np.repeat(simple, n_words)
        # a word at the start of its text has no space before it: it is a piece of its own
        piece = np.where(first, index + len(names), index)[use]
        wanted, inverse = np.unique(piece, return_inverse=True)
        strings = [names[i - len(names)] if i >= len(names) else f" {names[i]}" for i in wanted.tolist()]
        whole = texts.take(pa.array(np.flatnonzero(~simple))).to_pylist()
        encoded = self.encode_strings(strings)
        flat = np.concatenate([*encoded, np.zeros(0, np.int32)])
        length = np.fromiter(map(len, encoded), np.int64, len(encoded))
        start = np.cumsum(length) - length
        ids = flat[W.ragged(start[inverse], length[inverse])]
        counts = np.zeros(len(texts), np.int64)
        counts[simple] = W.sums(length[inverse], np.concatenate([[0], np.cumsum(n_words[simple])]))
        if whole:
            own = [np.array([i for p in self.encode_pretokens(self.pattern.findall(t)) for i in p], np.int32) for t in whole]
            counts[~simple] = [len(x) for x in own]
            ends = np.cumsum(counts)
            out = np.zeros(int(ends[-1]), np.int32)
            mask = np.repeat(simple, counts)
            out[mask] = ids
            out[~mask] = np.concatenate(own)
            ids = out
        return ids, np.concatenate([[0], np.cumsum(counts)])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids."""
        return self.token_bytes[W.ragged(self.token_start[ids], self.token_length[ids])].tobytes()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per vocabulary and Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ids (array of int) and decoded (binary): the bytes that the ids map back to."""
    share_code(docs.sparkSession)
    chosen = docs.select(*keep, F.col(text).alias("__text"))
    names = chosen.columns[:-1]
    out = W.schema(docs.select(*keep), "ids array<int>, decoded binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in W.slices(batches, "__text"):
            ids, bounds = own.encode(W.texts_of(batch, "__text"))
            at = np.concatenate([[0], np.cumsum(own.token_length[ids])])[bounds]
            decoded = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(own.decode(ids))])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)), decoded], names=[f.name for f in out.fields])

    return chosen.mapInArrow(run, out)
