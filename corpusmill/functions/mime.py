"""Content types by file extension, and the declared compression policy."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The content types that a store accepts.
CONTENT_TYPES = (
    "application/json",
    "application/xml",
    "font/ttf",
    "image/gif",
    "image/jpeg",
    "image/png",
    "image/svg+xml",
    "text/css",
    "text/html",
    "text/javascript",
    "text/markdown",
    "text/plain",
)
# Compression by major type, and the types that depart from it.
MAJOR_POLICY = {"text": "brotli", "image": "none", "application": "brotli"}
TYPE_POLICY = {"image/jpeg": "none", "image/png": "none", "image/gif": "none", "image/svg+xml": "brotli", "font/ttf": "none"}
# Extensions that the registry is asked to know besides its own.
ADDED_TYPES = {".svg": "image/svg+xml", ".ttf": "font/ttf"}


def compression_of(content_type: str) -> str:
    """The declared policy of a type."""
    return TYPE_POLICY.get(content_type) or MAJOR_POLICY.get(content_type.split("/")[0], "none")


def content_types(spark: SparkSession) -> DataFrame:
    """(id, value, compression): ids follow the sorted names, so every store has the same."""
    return spark.createDataFrame([(i, t, compression_of(t)) for i, t in enumerate(sorted(CONTENT_TYPES), 1)], "id long, value string, compression string")


def mime_map() -> dict[str, str]:
    """Extension to content type, by the standard library's own table (not the machine's files)."""
    return mimetypes.MimeTypes(filenames=()).types_map[True] | ADDED_TYPES


def mime_table(spark: SparkSession) -> DataFrame:
    """(suffix, content_type): a fixed table of about 150 rows."""
    return spark.createDataFrame(sorted(mime_map().items()), "suffix string, content_type string")


def policy(content_type: Column) -> Column:
    """The declared policy as an expression: exceptions first, then the major type."""
    exceptions = F.create_map(*(F.lit(x) for pair in TYPE_POLICY.items() for x in pair))
    majors = F.create_map(*(F.lit(x) for pair in MAJOR_POLICY.items() for x in pair))
    return F.coalesce(exceptions[content_type], majors[F.split_part(content_type, F.lit("/"), F.lit(1))], F.lit("none"))
