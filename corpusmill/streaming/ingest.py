"""Streaming ingest: new files of a folder go through the batch ingest, each micro-batch once.

Duplicates are settled by the store itself (a stored path is left alone), so a batch that runs again after a failure adds
nothing twice, and no state grows with the stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusmill.operators import store

_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def watch(spark: SparkSession, folder: str, store_dir: str, checkpoint: str, language: str = store.DEFAULT_LANGUAGE, once: bool = True) -> StreamingQuery:
    """Ingests the files of ``folder``, and with ``once=False`` those that come later."""
    files = spark.readStream.format("binaryFile").schema(_SCHEMA).load(folder).select(F.regexp_replace("path", "^file:(//)?", "").alias("path"), "content")

    def batch(rows: DataFrame, _: int) -> None:
        store.ingest(rows.sparkSession, rows, store_dir, language)

    writer = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def event_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of tumbling windows, for batch frames and, with late rows up to the watermark, for streams."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), kind, "n", "total")
