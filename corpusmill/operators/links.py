"""Links: extraction, audit against an inventory, url maps, and classification against them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import html, paths
from corpusmill.session import share_code

HREF = r'<a\s[^>]*?href="([^"]+)"'


def without_code(page: Column) -> Column:
    """A page without the text of scripts and style sheets, in which tags may be quoted."""
    return F.regexp_replace(page, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", "")


def quick_hrefs(pages: DataFrame, key: str, page: str = "html") -> DataFrame:
    """(key, ord, url) of all double-quoted links of ``a`` tags by expressions alone: for machine-written pages."""
    return pages.select(key, F.posexplode(F.regexp_extract_all(without_code(F.col(page)), F.lit(HREF), F.lit(1))).alias("ord", "url"))


def extract(pages: DataFrame, key: str, page: str = "html", tags: tuple[str, ...] | None = ("a",), attrs: tuple[str, ...] = ("href",)) -> DataFrame:
    """(key, ord, tag, attr, url) by a real parse of each page, once; tags None: any tag. Pages without any of the
    attributes never reach Python."""
    share_code(pages.sparkSession)
    kind = dict(pages.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *x) for i, text in enumerate(batch.column(1).to_pylist()) for x in html.links(html.parse(text), tags, attrs)]
            columns = list(zip(*rows, strict=True)) if rows else [[], [], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64())), pa.array(columns[1], pa.int64()), *(pa.array(c, pa.string()) for c in columns[2:])], names=[key, "ord", "tag", "attr", "url"])

    wanted = pages.where(F.lower(page).rlike("|".join(attrs)))
    return wanted.select(key, page).mapInArrow(run, f"`{key}` {kind}, ord long, tag string, attr string, url string")


def audit(links: DataFrame, inventory: DataFrame, file: str = "file", url: str = "url", path: str = "path") -> DataFrame:
    """``links`` with target and status: external, valid (a path that is there, or none at all) or broken. ``inventory``
    holds the paths that are there, files and folders."""
    target = paths.resolve(paths.dirname(F.col(file)), paths.url_path(F.col(url)))
    there = inventory.select(paths.collapse(F.col(path)).alias("target")).distinct().withColumn("there", F.lit(True))
    joined = links.withColumn("target", target).join(there, "target", "left")
    status = F.when(paths.has_external_scheme(F.col(url)), "external").when(paths.url_path(F.col(url)) == "", "valid").when(F.col("there"), "valid").otherwise("broken")
    return joined.withColumn("status", status).drop("there")


def folders(files: DataFrame, path: str = "path") -> DataFrame:
    """All paths of files and of the folders above them: (path)."""
    parts = F.split(path, "/")
    return files.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).alias("path")).where("path <> ''").distinct()


def url_maps(pairs: DataFrame, docs_path: str, site: str = paths.SITE_URL) -> tuple[DataFrame, DataFrame]:
    """From (line_no, url, rid): (url, file) and (rid, file_key); the last line of a key wins, combined map-side."""
    file = paths.join_path(F.lit(docs_path), paths.url_directory(F.col("url"), site), F.col("rid"))
    files = pairs.withColumn("file", file).groupBy("url").agg(F.max_by("file", "line_no").alias("file"))
    keys = pairs.withColumn("file_key", paths.url_key(F.col("url"), site)).groupBy("rid").agg(F.max_by("file_key", "line_no").alias("file_key"))
    return files, keys


def classify(links: DataFrame, url_map: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(valid, invalid, target): links in the map, links not in it, and the files of those in it; repeats are kept."""
    return links.join(url_map.select(url), url, "left_semi"), links.join(url_map.select(url), url, "left_anti"), links.join(url_map, url)


def menu_by_id(cache: DataFrame, menu_id: int) -> DataFrame:
    """The menu of an id from (seq, menu_html, menu_id); of several the last."""
    return cache.where(F.col("menu_id") == menu_id).groupBy("menu_id").agg(F.max_by("menu_html", "seq").alias("menu_html"))


def media_plan(sources: DataFrame, url_map: DataFrame, rid_map: DataFrame, inventory: DataFrame, folder: str) -> DataFrame:
    """``sources`` (.., src) with url, local file (null if it is not there) and new_src below ``folder``."""
    there = inventory.select(F.col("path").alias("file")).distinct().withColumn("there", F.lit(True))
    rows = sources.withColumn("url", paths.absolute_url(F.col("src"))).join(url_map, "url", "left").join(there, "file", "left").withColumn("file", F.when(F.col("there"), F.col("file"))).drop("there")
    rows = rows.withColumn("rid", paths.basename(F.col("file"))).join(rid_map, "rid", "left")
    return rows.withColumn("new_src", F.when(F.col("file").isNotNull(), F.concat_ws("/", F.lit(folder), F.coalesce("file_key", "rid")))).drop("rid", "file_key")
