"""Tooltips from sheets and from class documentation, with row-level rejects and last-wins upserts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import html, paths
from corpusmill.functions.html import Node
from corpusmill.operators import store
from corpusmill.session import materialise, share_code
from corpusmill.sources import files, sheets

BUTTON = "struct<first:string,second:string>"
# Texts that stand for what a page does not have.
NO_SUMMARY, NO_DETAIL, UNKNOWN = "No summary available", "No detail found", "unknown"
SELF_LABEL = "View full documentation"


def reject_reason(row_idx: Column, columns: tuple[str, ...] = sheets.REQUIRED) -> Column:
    """The first required column that is empty (null, empty or the number 0; ``False`` is not), with the row; else null."""
    reasons = [F.when(F.col(c).isNull() | F.col(c).cast("string").isin("", "0"), F.concat(F.lit("Row "), row_idx.cast("string"), F.lit(f": empty {c}"))) for c in columns]
    return F.coalesce(*reasons)


def button(description: Column, uri: Column) -> Column:
    """A button, or null without a description or uri (``False`` as description makes none either)."""
    return F.when(description.isNotNull() & uri.isNotNull() & ~description.isin("", "False", "0") & (uri != ""), F.struct(description.alias("first"), uri.alias("second")))


def button_json(buttons: Column) -> Column:
    """Buttons as JSON text."""
    return F.to_json(buttons)


def from_rows(rows: DataFrame, old_site: str = "https://kotlinlang.org/docs/", new_site: str = "http://localhost:6174/KotlinDocs/html/") -> tuple[DataFrame, DataFrame]:
    """(tooltips with seq, skipped (row_idx, error)) of sheet rows."""
    judged = rows.withColumn("error", reject_reason(F.col("row_idx")))
    moved = lambda n: paths.moved_url(F.col(f"buttonURI{n}"), old_site, new_site)
    buttons = F.filter(F.array(*(button(F.col(f"buttonDescr{n}"), moved(n)) for n in (1, 2, 3))), lambda b: b.isNotNull())
    good = judged.where("error is null").select(F.col("category").alias("tooltipCategory"), F.col("tag").cast("string").alias("tooltipTag"), F.col("summary").alias("tooltipSummary"), F.coalesce(F.nullif("detail", F.lit("")), F.lit(" ")).alias("tooltipDetail"), button_json(buttons).alias("tooltipButtons"), F.col("row_idx").alias("seq"))
    return good, judged.where("error is not null").select("row_idx", "error")


def import_sheet(spark: SparkSession, path: str, store_dir: str) -> dict[str, object]:
    """Upserts a sheet's rows: total, processed (total less skipped) and skipped rows with their reasons."""
    rows = materialise(sheets.tooltip_sheet(spark, path), "sheet")
    good, skipped = from_rows(rows)
    store.upsert(spark, good, store_dir, store.TOOLTIPS, ["tooltipCategory", "tooltipTag"])
    total, errors = rows.count(), [tuple(r) for r in skipped.orderBy("row_idx").collect()]
    return {"skipped_rows": errors, "total_rows": total, "processed_rows": total - len(errors)}


def class_index(root: Node) -> list[tuple[str, str]]:
    """(url, description) of an index of classes: first and last columns side by side, header rows left out."""
    panel = root.find(lambda n: n.tag == "div" and n.attrs.get("id") == "all-classes-table.tabpanel")
    if panel is None:
        return []
    column = lambda name: [n for n in panel.find_all("div") if name in n.classes]
    out = []
    for first, last in zip(column("col-first"), column("col-last"), strict=False):
        link = None if "table-header" in first.classes else first.find("a")
        if link is None or "href" not in link.attrs:
            continue
        if any(c.tag is None and c.text.strip() == "Deprecated." for n in (last, *last.walk()) for c in n.children):
            comment = last.find(lambda n: n.tag == "div" and "deprecation-comment" in n.classes)
            text = "Deprecated." + (f" {comment.serialise()}" if comment else "")
        else:
            block = last.find(lambda n: n.tag == "div" and "block" in n.classes)
            text = block.serialise() if block else ""
        out.append((link.attrs["href"], text.replace("\n", " ")))
    return out


def class_page(root: Node, path: str) -> dict[str, object]:
    """kind, tag, detail and links (label, href as written) of a class page; one parse for all of them."""
    kind, tag = UNKNOWN, UNKNOWN
    for meta in root.find_all(lambda n: n.tag == "meta" and n.attrs.get("name") == "keywords"):
        content = meta.attrs.get("content") or ""
        if "(" not in content and len(content.split()) == 2:
            tag, kind = content.split()
            break
    section = root.find(lambda n: n.tag == "section" and "class-description" in n.classes)
    detail = NO_DETAIL if section is None else "".join(c.serialise() for c in section.children if not (c.tag == "div" and "type-signature" in c.classes))
    links, header = [], root.find(lambda n: n.tag == "div" and "header" in n.classes)
    for sub in header.find_all(lambda n: n.tag == "div" and "sub-title" in n.classes) if header else ():
        link = sub.find("a")
        for label, form in (("module-label-in-type", "Learn more about the {} module"), ("package-label-in-type", "Learn more about {} package")):
            if link is not None and sub.find(lambda n, label=label: n.tag == "span" and label in n.classes):
                links.append({"first": form.format(link.all_text()), "second": link.attrs.get("href") or ""})
    links.append({"first": SELF_LABEL, "second": path.rsplit("/", 1)[-1]})
    return {"kind": kind, "tag": tag, "detail": detail, "links": links}


_PAGE = T.StructType([T.StructField("path", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("tag", T.StringType()), T.StructField("detail", T.StringType()), T.StructField("links", T.ArrayType(T.StructType([T.StructField("first", T.StringType()), T.StructField("second", T.StringType())])))])


def class_pages(pages: DataFrame) -> DataFrame:
    """(path, kind, tag, detail, links) of pages (path, content)."""
    share_code(pages.sparkSession)
    links = pa.list_(pa.struct([("first", pa.string()), ("second", pa.string())]))
    schema = pa.schema([("path", pa.string()), ("kind", pa.string()), ("tag", pa.string()), ("detail", pa.string()), ("links", links)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([{"path": p, **class_page(html.parse(c.decode("utf-8", "replace")), p)} for p, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)], schema)

    return pages.select("path", "content").mapInArrow(run, _PAGE)


def class_tooltips(pages: DataFrame, index: DataFrame, root: str, category: str = "java") -> DataFrame:
    """Tooltips with seq (the path: the last page of a tag wins) of class pages and an index (url, description, seq: the last
    entry of a url wins)."""
    parsed = class_pages(pages).withColumn("url", paths.relative_to(F.col("path"), root))
    named = parsed.join(index.groupBy("url").agg(F.max_by("description", "seq").alias("description")), "url", "left")
    buttons = F.transform("links", lambda b: F.struct(b["first"].alias("first"), paths.button_uri(F.col("path"), b["second"]).alias("second")))
    return named.select(F.lit(category).alias("tooltipCategory"), F.col("tag").alias("tooltipTag"), F.coalesce("description", F.lit(NO_SUMMARY)).alias("tooltipSummary"), F.col("detail").alias("tooltipDetail"), button_json(buttons).alias("tooltipButtons"), F.col("path").alias("seq"))


def import_class_docs(spark: SparkSession, folder: str, store_dir: str) -> int:
    """Upserts the tooltips of a folder of class documentation; the number of pages."""
    index_file = files.binary(spark, f"{folder}/allclasses-index.html").select("content")
    rows = [p for r in index_file.collect() for p in class_index(html.parse(r.content.decode("utf-8", "replace")))]
    index = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "url string, description string, seq long")
    tips = materialise(class_tooltips(files.class_docs(spark, folder), index, folder), "class-docs")
    store.upsert(spark, tips, store_dir, store.TOOLTIPS, ["tooltipCategory", "tooltipTag"])
    return tips.count()
