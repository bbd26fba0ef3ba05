"""Corpus analysis: sizes by extension, shares, small groups folded together, differences of two corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import paths

REDIRECT = "You will be redirected"
NO_EXTENSION = "None"
OTHER = "OTHER"


def by_extension(files: DataFrame, extension: str = "file_extension", size: str = "file_size") -> DataFrame:
    """Files, smallest, mean (floor), largest and total size of each extension; files without one are a group."""
    return files.groupBy(F.coalesce(extension, F.lit(NO_EXTENSION)).alias("file_extension")).agg(
        F.count("*").alias("num_files"),
        F.min(size).cast("long").alias("min_file_size"),
        F.floor(F.avg(size)).cast("long").alias("mean_file_size"),
        F.max(size).cast("long").alias("max_file_size"),
        F.sum(size).cast("long").alias("total_size"),
    )


def names_by_extension(files: DataFrame, root: str, extension: str = "file_extension", name: str = "file_name") -> DataFrame:
    """The sorted distinct names of each extension's files, without the root. Repeats go before names are gathered."""
    names = files.select(F.coalesce(extension, F.lit(NO_EXTENSION)).alias("file_extension"), paths.without_root(F.col(name), root).alias("name")).distinct()
    return names.groupBy("file_extension").agg(F.sort_array(F.collect_list("name")).alias("file_names"))


def extensions_in_order(files: DataFrame, seq: str) -> DataFrame:
    """Distinct extensions by first appearance."""
    return files.groupBy(F.coalesce("file_extension", F.lit(NO_EXTENSION)).alias("file_extension")).agg(F.min(seq).alias("first_seen")).orderBy("first_seen")


def fold_small(sizes: DataFrame, label: str, value: str, least: Column | int) -> DataFrame:
    """(label, value, members): labels whose value is below ``least`` become one OTHER, which is there even if empty; in order of label."""
    named = sizes.select(F.when(F.col(value) < least, OTHER).otherwise(F.col(label)).alias("label"), F.col(value).alias("value"), F.when(F.col(value) < least, F.col(label)).alias("member"))
    none = sizes.sparkSession.createDataFrame([(OTHER,)], "label string").select("label", F.lit(0).cast("long").alias("value"), F.lit(None).cast("string").alias("member"))
    return named.unionByName(none).groupBy("label").agg(F.sum("value").cast("long").alias("value"), F.sort_array(F.collect_list("member")).alias("members")).orderBy("label")


def shares(rows: DataFrame, value: str) -> DataFrame:
    """``rows`` with each value's percentage of their sum; for aggregated rows, which are few."""
    return rows.withColumn("percent", F.col(value) * 100.0 / F.sum(value).over(Window.partitionBy()))


def names_only_in(left: DataFrame, right: DataFrame, name: str = "name") -> DataFrame:
    """Distinct names of ``left`` that ``right`` has not."""
    return left.select(name).distinct().join(right.select(name).distinct(), name, "left_anti")


def redirects(pages: DataFrame, text: str = "text") -> DataFrame:
    """(is_redirect, files, characters)."""
    return pages.groupBy(F.coalesce(F.col(text).contains(REDIRECT), F.lit(False)).alias("is_redirect")).agg(F.count("*").alias("files"), F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias("characters"))


def totals(files: DataFrame, size: str = "file_size") -> DataFrame:
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("total_size"))
