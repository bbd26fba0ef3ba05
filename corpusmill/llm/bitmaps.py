"""Bitmaps of hashes, of a fixed size: what is not in one for certain need not be shuffled."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits, as a power of two.
BITS = 22


def column_of(bits: np.ndarray) -> Column:
    """64-bit words as a constant of the plan."""
    return F.from_json(F.lit("[" + ",".join(map(str, bits.tolist())) + "]"), "array<bigint>")


def _place(value: Column) -> Column:
    return F.pmod(value, F.lit(1 << BITS)).cast("int")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63))


def of(hashes: DataFrame, name: str) -> np.ndarray:
    """The words of the bitmap of a column of 64-bit hashes; the driver gets no more than these words."""
    at = _place(F.col(name))
    bits = np.zeros(1 << (BITS - 6), np.int64)
    found = hashes.groupBy(F.shiftright(at, 6).alias("word")).agg(F.bit_or(_bit(at)).alias("some")).toArrow()  # one job for all partitions
    bits[found["word"].to_numpy()] = found["some"].to_numpy()
    return bits


def test(bits: np.ndarray) -> Callable[[Column], Column]:
    """Whether a hash may be in the bitmap."""
    known = column_of(bits)
    return lambda value: F.get(known, F.shiftright(_place(value), 6)).bitwiseAND(_bit(_place(value))) != 0
