"""Sinks: line files, TSV, one file per row, copy plans, run parameters, style sheets and scripts."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, header: bool = True, columns: list[str] | None = None) -> None:
    """Tab-separated files, a column subset if asked for."""
    df.select(*(columns or df.columns)).write.mode("overwrite").csv(path, sep="\t", header=header, emptyValue="")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    """One line per row; null lines are left out."""
    df.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def write_files(df: DataFrame, folder: str, name: str = "path", content: str = "content") -> DataFrame:
    """One file per row below ``folder`` (which all executors see), written where the rows are: (path, bytes). Absolute
    names and steps upwards are refused."""

    def write(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                target = os.path.normpath(os.path.join(folder, n))
                if not target.startswith(os.path.normpath(folder) + os.sep):
                    raise ValueError(f"outside the folder: {n}")
                os.makedirs(os.path.dirname(target), exist_ok=True)
                data = c if isinstance(c, bytes) else (c or "").encode()
                part = f"{target}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, target)
                out.append({"path": n, "bytes": len(data)})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("path", pa.string()), ("bytes", pa.int64())]))

    return df.select(F.col(name), F.col(content)).mapInArrow(write, "path string, bytes long")


def copy_files(plan: DataFrame) -> DataFrame:
    """Carries out a copy plan (src, dst) on the executors; targets are replaced: (src, dst, copied)."""

    def copy(batches):
        import pyarrow as pa

        for batch in batches:
            done = []
            for src, dst in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                there = os.path.isfile(src)
                if there:
                    os.makedirs(os.path.dirname(dst), exist_ok=True)
                    shutil.copy2(src, dst)
                done.append({"src": src, "dst": dst, "copied": there})
            yield pa.RecordBatch.from_pylist(done, pa.schema([("src", pa.string()), ("dst", pa.string()), ("copied", pa.bool_())]))

    return plan.select("src", "dst").mapInArrow(copy, "src string, dst string, copied boolean")


def run_parameters(spark: SparkSession, parameters: dict[str, object]) -> DataFrame:
    """``name: value`` lines of a run's parameters."""
    return spark.createDataFrame([(k, str(v), f"{k}: {v}") for k, v in parameters.items()], "name string, value string, line string")


ARTICLE_CSS = """\
body { margin: 0 auto; max-width: 60rem; padding: 1rem; font-family: sans-serif; line-height: 1.5; }
.to-menu { padding: 1rem 0; font-size: 1.5rem; }
pre, .code-block { overflow-x: auto; font-family: monospace; white-space: pre-wrap; }
img, svg { max-width: 100%; height: auto; }
"""
SITE_CSS = """\
.container { margin: 0 auto; max-width: 64rem; padding: 1rem; }
.menu-link { font-size: 2rem; text-align: center; }
a.external { color: #8b0000; }
a.existing { color: #00408b; }
a.non-existing { color: #666; text-decoration: line-through; }
"""
TOC_CSS = """\
.contents { padding: 0.5rem; font-family: sans-serif; }
#toc-list { margin: 0; padding: 0; list-style: none; line-height: 1.7; }
#toc-list .hidden { display: none; }
#toc-list .heading { cursor: pointer; }
.twist { display: inline-block; width: 1.2em; }
.open > .twist { transform: rotate(90deg); }
"""
TOC_JS = """\
document.querySelectorAll("#toc-list .heading").forEach((head) => head.addEventListener("click", () => {
  const items = [...document.querySelectorAll("#toc-list li")];
  const below = (id) => items.filter((item) => item.dataset.parent === id);
  const hideAll = (id) => below(id).forEach((item) => { item.classList.add("hidden"); item.classList.remove("open"); hideAll(item.dataset.id); });
  if (head.classList.toggle("open")) below(head.dataset.id).forEach((item) => item.classList.remove("hidden"));
  else hideAll(head.dataset.id);
}));
"""


def assets(spark: SparkSession, which: Iterable[str] = ("article.css", "style.css", "toc.css", "toc.js")) -> DataFrame:
    """(path, content) of the style sheets and the script that rewritten documents refer to."""
    known = {"article.css": ARTICLE_CSS, "style.css": SITE_CSS, "toc.css": TOC_CSS, "toc.js": TOC_JS}
    return spark.createDataFrame([(name, known[name]) for name in which], "path string, content string")
