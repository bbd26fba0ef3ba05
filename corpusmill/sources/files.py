"""File scans: inventories, texts and bytes through Spark's own readers, so any Hadoop path works and scans distribute."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import paths

# Names that a scan of class documentation leaves out.
CLASS_DOC_EXCLUDED_PATTERNS = (r"^all(classes|packages|modules)-index\.html", r"^(module|package|class)-summary\.html", r"^index-\d+\.html", r"^coll-.+\.html")
CLASS_DOC_EXCLUDED_NAMES = (
    "Object.html",
    "Comparable.html",
    "package-use.html",
    "package-tree.html",
    "constant-values.html",
    "overview-tree.html",
    "index.html",
    "new-list.html",
    "threadPrimitiveDeprecation.html",
    "serialized-form.html",
    "deprecated-list.html",
    "overview-summary.html",
    "ValueBased.html",
    "help-doc.html",
    "system-properties.html",
    "preview-list.html",
    "net-properties.html",
)


def _plain(path: Column) -> Column:
    """A file's path without its scheme."""
    return F.regexp_replace(path, "^file:(//)?", "")


def binary(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, length, content) of a file, or of a directory's files; columns that a query leaves out are not read.

    Spark's scan passes over files of no bytes, so they are added from its file index, which the driver has anyway.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path)
    listed = spark.createDataFrame([(unquote(f),) for f in rows.inputFiles()], "path string").select(_plain(F.col("path")).alias("path"))
    rows = rows.select(_plain(F.col("path")).alias("path"), "length", "content")
    none = listed.join(rows.select("path"), "path", "left_anti").select("path", F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content"))
    return rows.unionByName(none)


def html_files(spark: SparkSession, path: str, recursive: bool = True, long_suffix: bool = True) -> DataFrame:
    """HTML files by suffix in any letter case: (path, length, content)."""
    return binary(spark, path, recursive).where(F.lower("path").rlike("[.]html?$" if long_suffix else "[.]html$"))


def class_docs(spark: SparkSession, path: str) -> DataFrame:
    """Pages of single classes below ``path``: no usage pages, summaries, indexes."""
    name = paths.basename(F.col("path"))
    rows = binary(spark, path, recursive=True).where(F.col("path").endswith(".html") & ~F.col("path").contains("/class-use/") & ~name.isin(*CLASS_DOC_EXCLUDED_NAMES))
    for pattern in CLASS_DOC_EXCLUDED_PATTERNS:
        rows = rows.where(~name.rlike(pattern))
    return rows


def inventory(spark: SparkSession, *roots: str) -> DataFrame:
    """(root, file_name, file_size, file_extension) of all files below the roots; no content is read."""
    parts = [binary(spark, r, recursive=True).select(F.lit(r).alias("root"), F.col("path").alias("file_name"), F.col("length").alias("file_size"), paths.extension(F.col("path")).alias("file_extension")) for r in roots]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def total_bytes(files: DataFrame) -> DataFrame:
    """Bytes of all files of an inventory (directories themselves count nothing)."""
    return files.agg(F.coalesce(F.sum("file_size"), F.lit(0)).alias("total_bytes"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Trimmed, non-empty lines: (line_no, line). Numbers grow in file order but have gaps."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), F.trim("value").alias("line")).where("line <> ''")


def whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row with a file's trimmed text, such as a version stamp."""
    return spark.read.text(path, wholetext=True).select(F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("text"))


def docs_version(spark: SparkSession, folder: str, name: str = "docs_version.txt") -> DataFrame:
    """(docs_version): the stamp that a staged corpus carries (one row; null if the file is empty)."""
    return whole_text(spark, f"{folder}/{name}").select(F.nullif("text", F.lit("")).alias("docs_version"))


def staged(spark: SparkSession, folder: str, name: str = "docs_version.txt") -> DataFrame:
    """The files of a staged corpus without the stamp itself, each with its ``docs_version``."""
    rows = binary(spark, folder, recursive=True).where(paths.basename(F.col("path")) != name)
    return rows.withColumn("docs_version", F.lit(docs_version(spark, folder, name).first().docs_version))


def with_content(files: DataFrame, content: DataFrame) -> DataFrame:
    """Inventory rows with their text, for substring tests."""
    return files.join(content.select(F.col("path").alias("file_name"), F.decode("content", "utf-8").alias("text")), "file_name")


def unzip(spark: SparkSession, path: str) -> DataFrame:
    """(archive, path, content) of the members of zip files, one archive at a time per task."""
    import io
    import zipfile

    def members(batches):
        import pyarrow as pa

        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(data)) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            yield pa.RecordBatch.from_pylist([{"archive": name, "path": info.filename, "content": archive.read(info)}], pa.schema([("archive", pa.string()), ("path", pa.string()), ("content", pa.binary())]))

    return binary(spark, path).select("path", "content").mapInArrow(members, "archive string, path string, content binary")


def synthetic(spark: SparkSession, files: int = 100, seed: int = 0, kinds: tuple[str, ...] = ("html", "txt", "css", "md", "json", "js")) -> DataFrame:
    """(path, content): made-up files of random kinds; the same seed gives the same files."""
    kind = F.array(*map(F.lit, kinds))[(F.rand(seed) * len(kinds)).cast("int")]
    words = F.transform(F.sequence(F.lit(1), (F.rand(seed + 1) * 200 + 5).cast("int")), lambda i: F.conv(F.substring(F.sha2(F.concat_ws(":", F.col("id"), i, F.lit(seed)), 256), 1, 8), 16, 36))
    return spark.range(files).select(F.concat(F.lit("file"), F.col("id").cast("string"), F.lit("."), kind).alias("path"), F.encode(F.array_join(words, " "), "utf-8").alias("content"))
