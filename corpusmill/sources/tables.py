"""Tabular and structured sources: url maps, tables of contents, SQLite files, search indexes."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ENTRY = "struct<id:string,title:string,url:string,level:int,parentId:string,pages:array<string>,tabIndex:int>"


def url_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, url, rid) of a two-column TSV; blank lines are left out, other lines without exactly two fields fail."""
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.trim("value").alias("line")).where("line <> ''")
    fields = F.split("line", "\t")
    checked = F.when(F.size(fields) == 2, fields).otherwise(F.raise_error(F.concat(F.lit("not two fields: "), F.col("line"))))
    return rows.select("line_no", checked.alias("f")).select("line_no", F.col("f")[0].alias("url"), F.col("f")[1].alias("rid"))


def toc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(entries, roots) of a table-of-contents JSON file: entries (seq, id, title, url, level, parentId, pages, tabIndex)
    in file order, roots (pos, id). The map may stand under ``entities.pages`` or ``entities``; missing parts are empty."""
    text = spark.read.text(path, wholetext=True)
    body = F.get_json_object("value", "$.entities.pages")
    body = F.coalesce(body, F.get_json_object("value", "$.entities"), F.lit("{}"))
    entries = text.select(F.posexplode(F.map_entries(F.from_json(body, f"map<string,{ENTRY}>"))).alias("seq", "e")).select("seq", F.coalesce("e.value.id", "e.key").alias("id"), *(F.col(f"e.value.{c}").alias(c) for c in ("title", "url", "level", "parentId", "pages", "tabIndex")))
    roots = text.select(F.posexplode(F.from_json(F.coalesce(F.get_json_object("value", "$.topLevelIds"), F.lit("[]")), "array<string>")).alias("pos", "id"))
    return entries, roots


def search_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows (p, l, u, m, h, d) of a search index that a script assigns to a variable."""
    array = F.regexp_extract("value", r"(?s)^[^\[=]*=\s*(\[.*?\])\s*;?.*$", 1)
    return spark.read.text(path, wholetext=True).select(F.explode(F.from_json(array, "array<struct<p:string,l:string,u:string,m:string,h:string,d:string>>")).alias("r")).select("r.*")


class SqliteReader(DataSourceReader):
    """Reads a query in ranges of rowid, one task each."""

    def __init__(self, path: str, table: str, columns: list[str], parts: int):
        self.path, self.table, self.columns, self.parts = path, table, columns, parts

    def partitions(self) -> list[InputPartition]:
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            lo, hi = db.execute(f'SELECT coalesce(min(rowid), 0), coalesce(max(rowid), -1) FROM "{self.table}"').fetchone()
        step = max(1, -(-(hi - lo + 1) // self.parts))
        return [InputPartition((a, a + step)) for a in range(lo, hi + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        a, b = partition.value
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            names = ", ".join(f'"{c}"' for c in self.columns)
            yield from db.execute(f'SELECT {names} FROM "{self.table}" WHERE rowid >= ? AND rowid < ?', (a, b))


class SqliteSource(DataSource):
    """``spark.read.format("sqlite_table").schema(...).option("path", ...).option("table", ...)``"""

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(self.options["path"], self.options["table"], schema.fieldNames(), int(self.options.get("parts", 8)))


def sqlite(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """A table of a SQLite file that all executors see."""
    spark.dataSource.register(SqliteSource)
    return spark.read.format("sqlite_table").schema(schema).option("path", path).option("table", table).load()
