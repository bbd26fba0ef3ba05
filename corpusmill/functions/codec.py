"""Codecs for stored content: Arrow-batched, chosen by name, recorded beside the bytes."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import brotli
except ImportError:
    brotli = None


def _deflate(data: bytes) -> bytes:
    return zlib.compress(data, 9)


ENCODERS: dict[str, Callable[[bytes], bytes]] = {"none": bytes, "deflate": _deflate}
DECODERS: dict[str, Callable[[bytes], bytes]] = {"none": bytes, "deflate": zlib.decompress}
if brotli is not None:
    ENCODERS["brotli"], DECODERS["brotli"] = brotli.compress, brotli.decompress
#: What a declared ``brotli`` is stored as here.
COMPRESSED = "brotli" if brotli is not None else "deflate"
#: The token of each codec in Accept-Encoding and Content-Encoding.
TOKENS = {"brotli": "br", "deflate": "deflate"}


def stored_codec(policy: Column) -> Column:
    return F.when(policy == "brotli", F.lit(COMPRESSED)).otherwise(F.lit("none"))


@F.pandas_udf(T.BinaryType())
def compress(content: pd.Series, codec: pd.Series) -> pd.Series:
    return pd.Series([None if c is None else ENCODERS[k](c) for c, k in zip(content, codec, strict=True)])


@F.pandas_udf(T.BinaryType())
def decompress(content: pd.Series, codec: pd.Series) -> pd.Series:
    return pd.Series([None if c is None else DECODERS[k](c) for c, k in zip(content, codec, strict=True)])


def encoded(content: Column, codec: Column) -> Column:
    """Content as it is stored; what needs no codec stays in the JVM."""
    return F.when(codec == "none", content).otherwise(compress(content, codec))


def decoded(content: Column, codec: Column) -> Column:
    """Stored content as it was, by the codec recorded beside it."""
    return F.when(codec == "none", content).otherwise(decompress(content, codec))


def is_png(content: Column) -> Column:
    """Signature, header chunk and, with its checksum, end chunk of a PNG file; what follows that is ignored."""
    head = (F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A") & (F.hex(F.substring(content, 13, 4)) == "49484452")
    return head & F.contains(F.decode(content, "ISO-8859-1"), F.lit("IEND\u00aeB`\u0082"))


def step(edit: Callable[[bytes], bytes]) -> Callable[[Column], Column]:
    """A function of bytes, such as an external compressor of pictures, as a column expression in Arrow batches."""

    @F.pandas_udf(T.BinaryType())
    def run(content: pd.Series) -> pd.Series:
        return content.map(lambda c: None if c is None else edit(c))

    return run
