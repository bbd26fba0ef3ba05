"""Columnar text helpers for Arrow-batched operators.

A batch of texts is cut into slices of bounded bytes; each slice is split once in C++ and dictionary-encoded, so that
Python only ever touches *distinct* strings. Whole texts are processed, whatever their length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

try:
    _LIBC = ctypes.CDLL("libc.so.6")
except OSError:  # another C library
    _LIBC = None

SLICE_BYTES = 4 << 20
#: ASCII white space to one space.
SPACES = bytes(32 if b in (9, 10, 11, 12, 13) else b for b in range(256))
#: The same, and A-Z to a-z.
SPACES_LOWER = bytes(b + 32 if 65 <= b <= 90 else SPACES[b] for b in range(256))


def trim() -> None:
    """Gives freed memory back to the machine: workers live on from task to task, beside their executor's heap."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each slice has at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.nan_to_num(pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False).astype(float))
        start, total = 0, 0.0
        for i, n in enumerate(size):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0.0
            total += n
        yield batch.slice(start)
        trim()


def texts_of(batch: pa.RecordBatch, text: str) -> pa.Array:
    """The text column as large strings without nulls (null: empty)."""
    return pc.fill_null(batch.column(text).cast(pa.large_string()), "")


def mapped(texts: pa.Array, table: bytes) -> pa.Array:
    """Each byte of every text (large strings without nulls) through ``table``, which changes ASCII only."""
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    own = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(table) if data else b""
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer((ends - ends[0]).tobytes()), pa.py_buffer(own)])


def split_words(texts: pa.Array, keep_empty: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(bounds, index, distinct): words of text i are ``distinct[index[bounds[i]:bounds[i + 1]]]``, split at single spaces."""
    lists = pc.split_pattern(texts, " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    bounds, index, distinct = offsets - offsets[0], flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.dictionary
    if keep_empty or not len(distinct):
        return bounds, index, distinct
    empty = np.flatnonzero(pc.binary_length(distinct).to_numpy(zero_copy_only=False) == 0)
    if len(empty):
        real = index != empty[0]
        bounds = np.concatenate([[0], np.cumsum(real)])[bounds]
        index = index[real]
    return bounds, index, distinct


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i] .. starts[i] + lengths[i] - 1``, one run after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each of the runs that ``bounds`` marks; empty runs give 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:]), values.dtype), np.cumsum(values, axis=0)])
    return total[bounds[1:]] - total[bounds[:-1]]


def schema(frame: DataFrame, ddl: str) -> T.StructType:
    """The columns of ``frame``, then those of the DDL text. A kept column that is named like an output is refused."""
    made = T.StructType.fromDDL(ddl).fields
    clash = sorted({f.name.lower() for f in made} & {c.lower() for c in frame.columns})
    if clash:
        raise ValueError(f"kept columns are named like outputs: {clash}")
    return T.StructType([*frame.schema.fields, *made])
