"""Spreadsheets (.xlsx) as a Spark data source, on zipfile and ElementTree alone."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

# The header that a tooltip sheet must have, and the columns that must not be empty.
HEADER = ("tag", "category", "summary", "detail", "buttonDescr1", "buttonURI1", "buttonDescr2", "buttonURI2", "buttonDescr3", "buttonURI3")
REQUIRED = ("tag", "category", "summary", "buttonDescr1", "buttonURI1")

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def read_cells(path: str) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells as text) of the active sheet; booleans are ``True`` and ``False``, numbers as written."""
    with zipfile.ZipFile(path) as book:
        names = set(book.namelist())
        shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        root = ElementTree.fromstring(book.read("xl/workbook.xml"))
        view = root.find(f"{_MAIN}bookViews/{_MAIN}workbookView")
        sheets = root.find(f"{_MAIN}sheets")
        chosen = sheets[int(view.get("activeTab", 0)) if view is not None else 0].get(f"{_REL}id")
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        target = targets[chosen]
        with book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as sheet:
            number = 0
            for _, row in ElementTree.iterparse(sheet):
                if row.tag != f"{_MAIN}row":
                    continue
                number = int(row.get("r", number + 1))
                cells: list[str | None] = []
                for i, c in enumerate(row):
                    at = _column(c.get("r")) if c.get("r") else i
                    cells += [None] * (at + 1 - len(cells))
                    kind, value = c.get("t"), c.findtext(f"{_MAIN}v")
                    if kind == "s" and value is not None:
                        value = shared[int(value)]
                    elif kind == "b" and value is not None:
                        value = "True" if value == "1" else "False"
                    elif kind == "inlineStr":
                        value = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
                    cells[at] = value
                yield number, cells
                row.clear()


def check_header(path: str) -> None:
    """Fails unless the first row is exactly the required header."""
    _, cells = next(read_cells(path), (0, []))
    while cells and cells[-1] is None:
        cells.pop()
    if tuple(cells) != HEADER:
        raise ValueError(f"header must be {list(HEADER)}, not {cells}")


class SheetReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def read(self, partition) -> Iterator[tuple]:
        for number, cells in read_cells(self.path):
            if number > 1 and any(c is not None for c in cells):
                yield (number, *(cells + [None] * len(HEADER))[: len(HEADER)])


class SheetSource(DataSource):
    """``spark.read.format("tooltip_sheet").load(path)``: row_idx (1-based, the header is 1) and the header's columns."""

    @classmethod
    def name(cls) -> str:
        return "tooltip_sheet"

    def schema(self) -> str:
        return "row_idx long, " + ", ".join(f"{c} string" for c in HEADER)

    def reader(self, schema) -> DataSourceReader:
        return SheetReader(self.options["path"])


def tooltip_sheet(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a tooltip sheet, after a check of its suffix and header."""
    if not path.endswith(".xlsx"):
        raise ValueError(f"not an .xlsx file: {path}")
    check_header(path)
    spark.dataSource.register(SheetSource)
    return spark.read.format("tooltip_sheet").load(path)
