"""Command line: ``python -m corpusmill COMMAND ...``. Every command is a thin call of an operator."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths
from corpusmill.operators import documents, links, serve, store, toc, tooltips
from corpusmill.sources import files, sinks, tables


def session() -> SparkSession:
    return SparkSession.builder.appName("corpusmill").getOrCreate()


def ingest(spark: SparkSession, a: argparse.Namespace) -> None:
    if not a.file and not a.directory:
        raise SystemExit("give --file or --directory")
    report = store.ingest(spark, files.binary(spark, a.file or a.directory), a.store)
    report.groupBy("reject_reason").count().orderBy("reject_reason").show(truncate=False)


def create(spark: SparkSession, a: argparse.Namespace) -> None:
    store.create(spark, a.store)


def list_documents(spark: SparkSession, a: argparse.Namespace) -> None:
    for r in store.list_documents(store.read(spark, a.store, "Content")).orderBy("path").toLocalIterator():
        print(f"{r.path}\t{r.bytes}")


def stats(spark: SparkSession, a: argparse.Namespace) -> None:
    content = store.read(spark, a.store, "Content")
    store.stats(content).show()
    store.summary(content, store.read(spark, a.store, "ContentTypes")).orderBy("content_type").show(truncate=False)


def serve_store(spark: SparkSession, a: argparse.Namespace) -> None:
    with serve.server(spark, a.store, a.host, a.port) as running:
        print("serving on http://{}:{}".format(*running.server_address), flush=True)
        running.serve_forever()


def import_tooltips(spark: SparkSession, a: argparse.Namespace) -> None:
    if not os.path.exists(a.sheet):
        raise SystemExit(f"no such file: {a.sheet}")
    done = tooltips.import_sheet(spark, a.sheet, a.store)
    print(f"rows {done['total_rows']}, processed {done['processed_rows']}, skipped {len(done['skipped_rows'])}")
    for row, reason in done["skipped_rows"]:
        print(f"  {row}: {reason}")


def class_tooltips(spark: SparkSession, a: argparse.Namespace) -> None:
    print(tooltips.import_class_docs(spark, a.directory, a.store), "pages")


def audit_links(spark: SparkSession, a: argparse.Namespace) -> None:
    pages = files.html_files(spark, a.directory).select(F.col("path").alias("file"), F.decode("content", "utf-8").alias("html"))
    there = links.folders(files.inventory(spark, a.directory).select(F.col("file_name").alias("path"))).select(F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit("/"), "path")).alias("path"))
    status = links.audit(links.extract(pages, "file", tags=None, attrs=("href", "src")), there)
    sinks.write_tsv(status.select(paths.basename(F.col("file")).alias("file"), "url", "status"), a.output, header=False)


def extract_links(spark: SparkSession, a: argparse.Namespace) -> None:
    page = files.binary(spark, a.input).select("path", F.decode("content", "utf-8").alias("html"))
    sinks.write_lines(links.extract(page, "path").orderBy("ord"), "url", a.output)


def url_maps(spark: SparkSession, a: argparse.Namespace) -> None:
    urls, rids = links.url_maps(tables.url_pairs(spark, a.input), a.docs_path)
    urls.write.mode("overwrite").parquet(a.url_map)
    rids.write.mode("overwrite").parquet(a.rid_map)


def targets(spark: SparkSession, a: argparse.Namespace) -> None:
    found = files.lines(spark, a.links).select("line_no", paths.absolute_url(F.col("line")).alias("url"))
    valid, invalid, target = links.classify(found, spark.read.parquet(a.url_map))
    for frame, column, name in ((valid, "url", "valid"), (invalid, "url", "invalid"), (target, "file", "target")):
        sinks.write_lines(frame.orderBy("line_no"), column, f"{a.output}/{name}")


def menu(spark: SparkSession, a: argparse.Namespace) -> None:
    """Menus without attributes, as files of the same names."""
    pages = files.binary(spark, a.input).select(paths.basename(F.col("path")).alias("path"), F.decode("content", "utf-8").alias("html"))
    sinks.write_files(documents.rewrite(pages, "path", "html", documents.menu_only), a.output, content="clean").count()


def single_menu(spark: SparkSession, a: argparse.Namespace) -> None:
    sinks.write_lines(links.menu_by_id(spark.read.parquet(a.cache), a.menu_id), "menu_html", a.output)


def articles(spark: SparkSession, a: argparse.Namespace) -> None:
    pages = files.html_files(spark, a.input, recursive=False, long_suffix=False).select(paths.basename(F.col("path")).alias("path"), F.decode("content", "utf-8").alias("html"))
    sinks.write_files(documents.debloat_articles(pages, "path", "html", a.menu, a.stylesheet), a.output, content="clean").count()
    sinks.write_files(sinks.assets(spark, ["article.css"]).withColumn("path", F.lit(a.stylesheet)), a.output).count()


def site(spark: SparkSession, a: argparse.Namespace) -> None:
    pages = files.binary(spark, a.input, recursive=True).select("path", F.decode("content", "utf-8").alias("html"))
    sources = links.extract(pages, "path", "html", tags=None, attrs=("src",)).select("path", F.col("url").alias("src")).distinct()
    urls, rids = spark.read.parquet(a.url_map), spark.read.parquet(a.rid_map)
    there = urls.join(files.inventory(spark, a.docs_path).select(F.col("file_name").alias("file")), "file", "left_semi").select(F.col("file").alias("path"))
    media = links.media_plan(sources, urls, rids, there, a.media)
    sinks.copy_files(media.where("new_src is not null").select(F.col("file").alias("src"), F.concat(F.lit(f"{a.output}/"), "new_src").alias("dst")).distinct()).count()
    done = documents.debloat_site(pages, media, a.menu, a.size, "path", "html", rids).where("clean is not null")
    sinks.write_files(done, a.output, "output_name", "clean").count()
    sinks.write_files(sinks.assets(spark, ["style.css"]), a.output).count()
    sinks.write_lines(sinks.run_parameters(spark, vars(a)), "line", f"{a.output}/_parameters")


def build_toc(spark: SparkSession, a: argparse.Namespace) -> None:
    page = toc.document(toc.items(toc.flatten(*tables.toc(spark, a.json))), stylesheet="toc.css", script="toc.js")
    rows = spark.createDataFrame([("toc.html", page)], "path string, content string").unionByName(sinks.assets(spark, ["toc.css", "toc.js"]))
    sinks.write_files(rows, a.output).count()


COMMANDS = {
    "ingest": (ingest, ["--file", "--directory", "--store"]),
    "create": (create, ["--store"]),
    "list": (list_documents, ["--store"]),
    "stats": (stats, ["--store"]),
    "serve": (serve_store, ["--store", "--host", "--port"]),
    "import-tooltips": (import_tooltips, ["--sheet", "--store"]),
    "class-tooltips": (class_tooltips, ["--directory", "--store"]),
    "audit-links": (audit_links, ["--directory", "--output"]),
    "extract-links": (extract_links, ["--input", "--output"]),
    "url-maps": (url_maps, ["--input", "--docs-path", "--url-map", "--rid-map"]),
    "targets": (targets, ["--links", "--url-map", "--output"]),
    "menu": (menu, ["--input", "--output"]),
    "single-menu": (single_menu, ["--cache", "--menu-id", "--output"]),
    "articles": (articles, ["--input", "--output", "--menu", "--stylesheet"]),
    "site": (site, ["--input", "--output", "--docs-path", "--url-map", "--rid-map", "--menu", "--media", "--size"]),
    "toc": (build_toc, ["--json", "--output"]),
}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser("corpusmill", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (_, options) in COMMANDS.items():
        sub = commands.add_parser(name)
        for option in options:
            sub.add_argument(option, required=option not in ("--file", "--directory") or name != "ingest", type=int if option in ("--menu-id", "--port") else str)
    args = parser.parse_args(argv)
    COMMANDS[args.command][0](spark or session(), args)


if __name__ == "__main__":
    main()
