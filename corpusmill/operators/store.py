"""The content store: schema, ingest, upsert, lookups, statistics and audits over Parquet tables.

``ingest`` decides on narrow rows (path, reject reason, no content): a window per path for duplicates among the accepted and a
join with what is stored. Content is then joined to the accepted ones, shuffled once, and each gets one codec call.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from corpusmill.functions import codec, mime, paths
from corpusmill.session import drop_materialised, materialise, share_code

CONTENT = T.StructType.fromJson({"type": "struct", "fields": [{"name": n, "type": t, "nullable": False, "metadata": {}} for n, t in (("id", "long"), ("path", "string"), ("languageID", "long"), ("content", "binary"), ("contentTypeID", "long"), ("compression", "string"), ("input_bytes", "long"))]})
DEFAULT_LANGUAGE = "en-US"
TABLES = ("Content", "Languages", "ContentTypes")
TOOLTIPS = "ide_tooltip_table"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def table_names(spark: SparkSession, store: str) -> set[str]:
    """The tables in a store's folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(store)
    fs = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return {s.getPath().getName() for s in fs.listStatus(p) if not s.getPath().getName().startswith(("_", "."))} if fs.exists(p) else set()


def create(spark: SparkSession, store: str) -> None:
    """An empty store with its seed rows, unless a valid one is there; one with other tables is refused."""
    present = table_names(spark, store)
    if present:
        check_schema(present)
        return
    spark.createDataFrame([], CONTENT).write.parquet(f"{store}/Content")
    spark.createDataFrame([(1, DEFAULT_LANGUAGE)], "id long, value string").write.parquet(f"{store}/Languages")
    mime.content_types(spark).coalesce(1).write.parquet(f"{store}/ContentTypes")


def check_schema(present: set[str]) -> None:
    """All required tables, and none but them and the tooltips."""
    missing, unknown = set(TABLES) - present, present - set(TABLES) - {TOOLTIPS}
    if missing or unknown:
        raise ValueError(f"not a store: missing {sorted(missing)}, unknown {sorted(unknown)}")


def read(spark: SparkSession, store: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{store}/{name}")


def classify(files: DataFrame, languages: DataFrame, mime_types: DataFrame, types: DataFrame) -> DataFrame:
    """``files`` (path, language, content) with suffix, content_type, contentTypeID, languageID and reject_reason (null:
    accepted). The first reason counts: language, extension, XML, invalid image, type that the store has not."""
    named = files.withColumn("suffix", paths.suffix(F.col("path")))
    joined = named.join(F.broadcast(mime_types), "suffix", "left").join(F.broadcast(types.select(F.col("id").alias("contentTypeID"), F.col("value").alias("content_type"), F.col("compression").alias("policy"))), "content_type", "left").join(F.broadcast(languages.select(F.col("id").alias("languageID"), F.col("value").alias("language"))), "language", "left")
    reason = (
        F.when(F.col("languageID").isNull(), "unknown_language")
        .when(F.col("content_type").isNull(), "unknown_extension")
        .when((F.col("content_type") == "application/xml") | (F.col("suffix") == ".jhm"), "xml")
        .when((F.col("content_type") == "image/png") & ~codec.is_png(F.col("content")), "invalid_image")
        .when(F.col("contentTypeID").isNull(), "unknown_type")
    )
    return joined.withColumn("reject_reason", reason)


def first_per_key(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of least ``seq`` for each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).where("__n = 1").drop("__n")


def last_per_key(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """The row of greatest ``seq`` for each key: the outcome of one upsert after the other."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(seq)))).where("__n = 1").drop("__n")


def with_ids(rows: DataFrame, order: str, first: int, name: str = "id") -> DataFrame:
    """Dense ids, in a column ``name``, from ``first`` in the order of a unique column, without a single-task sort: ranks within ranges, plus the
    counts of the ranges before."""
    ranged = rows.repartitionByRange(order).withColumn("__part", F.spark_partition_id())
    ranked = ranged.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(order)))
    counts = ranked.groupBy("__part").agg(F.count("*").alias("__n"), F.min(order).alias("__lo"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__lo").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return ranked.join(F.broadcast(before.select("__part", "__before")), "__part").withColumn(name, F.col("__before") + F.col("__rank") + (first - 1)).drop("__part", "__rank", "__before")


def ingest(spark: SparkSession, files: DataFrame, store: str, language: str = DEFAULT_LANGUAGE, dedup_keys: tuple[str, ...] = ("path",), png: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Appends the accepted ones of ``files`` (path, content) and returns (source, path, reject_reason) of all, once their
    content is stored.

    Of the acceptable rows of a path, the first in the order of its original spelling wins; what is rejected takes no path.
    A path that is stored already is left alone, for any language unless ``dedup_keys`` holds ``language`` too. Rows that
    agree in path and content are one file. ``png`` is applied to the bytes of PNG files before they are stored (none: they
    stay as they are).
    """
    share_code(spark)
    create(spark, store)
    stored, languages, types = read(spark, store, "Content"), read(spark, store, "Languages"), read(spark, store, "ContentTypes")
    rows = files.select(F.col("path").alias("source"), F.xxhash64("content").alias("mark"), paths.normalize_path(F.col("path")).alias("path"), "content", F.lit(language).alias("language"))
    have = stored.join(F.broadcast(languages.withColumnsRenamed({"id": "languageID", "value": "language"})), "languageID").select(*dedup_keys).distinct().withColumn("stored", F.lit(True))
    narrow = classify(rows, languages, mime.mime_table(spark), types).select("source", "mark", "path", "language", "languageID", "contentTypeID", "content_type", "policy", "reject_reason")
    judged = narrow.join(have, list(dedup_keys), "left")
    good = F.col("reject_reason").isNull()
    order = Window.partitionBy(*dedup_keys, good).orderBy("source", "mark")
    taken = F.col("stored") | (F.row_number().over(order) > 1)
    judged = materialise(judged.withColumn("reject_reason", F.when(good & taken, "duplicate").otherwise(F.col("reject_reason"))), "ingest")
    first = (stored.agg(F.max("id")).first()[0] or 0) + 1
    accepted = with_ids(judged.where("reject_reason is null"), "path" if dedup_keys == ("path",) else "source", first).withColumn("compression", codec.stored_codec(F.col("policy")))
    bytes_of = rows.groupBy("source", "mark").agg(F.first("content").alias("content"))
    content = F.col("content") if png is None else F.when(F.col("content_type") == "image/png", codec.step(png)("content")).otherwise(F.col("content"))
    full = accepted.join(bytes_of, ["source", "mark"]).withColumn("raw_bytes", F.octet_length("content").cast("long")).withColumn("content", content)
    packed = full.select("id", "path", "languageID", codec.encoded(F.col("content"), F.col("compression")).alias("content"), "contentTypeID", "compression", F.col("raw_bytes").alias("input_bytes"))
    packed.write.mode("append").parquet(f"{store}/Content")
    report = f"{store}/_reports/{uuid.uuid4().hex}"
    judged.select("source", "path", "reject_reason").write.parquet(report)
    drop_materialised(judged)
    return spark.read.parquet(report)


def upsert(spark: SparkSession, rows: DataFrame, store: str, name: str, keys: list[str], seq: str = "seq") -> None:
    """Insert or replace by key; of equal keys in ``rows`` the greatest ``seq`` wins. The table is written anew beside the
    old one and swapped by two renames; a reader that opens it between them finds no table."""
    path = f"{store}/{name}"
    columns = [c for c in rows.columns if c != seq]
    new = last_per_key(rows, keys, seq).select(*columns)
    if _exists(spark, path):
        new = new.unionByName(spark.read.parquet(path).join(new.select(*keys), keys, "left_anti").select(*columns))
    jvm = spark.sparkContext._jvm
    fresh, old = (jvm.org.apache.hadoop.fs.Path(f"{store}/.{name}-{uuid.uuid4().hex}") for _ in range(2))
    new.write.parquet(fresh.toString())
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(fresh, target)
    fs.delete(old, True)


def summary(content: DataFrame, types: DataFrame) -> DataFrame:
    """Files by content type: a broadcast join with the small type table, then a map-side combined count."""
    return content.join(F.broadcast(types.select(F.col("id").alias("contentTypeID"), F.col("value").alias("content_type"))), "contentTypeID").groupBy("content_type").agg(F.count("*").alias("files"))


def stats(content: DataFrame) -> DataFrame:
    """Files, bytes before and after compression, and the share saved in percent (null without input)."""
    totals = content.agg(F.count("*").alias("files"), F.coalesce(F.sum("input_bytes"), F.lit(0)).alias("input_bytes"), F.coalesce(F.sum(F.octet_length("content").cast("long")), F.lit(0)).alias("stored_bytes"))
    return totals.withColumn("percent_saved", F.when(F.col("input_bytes") > 0, paths.percent_saved(F.col("input_bytes"), F.col("stored_bytes"))))


def list_documents(content: DataFrame) -> DataFrame:
    """Path and stored bytes of every file."""
    return content.select("path", F.octet_length("content").cast("long").alias("bytes"))


def suffixes(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sorted distinct suffixes, names without one)."""
    named = files.select("path", paths.suffix(F.col("path")).alias("suffix"))
    return named.where("suffix <> ''").select("suffix").distinct().orderBy("suffix"), named.where("suffix = ''").select("path").orderBy("path")


def get_file(content: DataFrame, languages: DataFrame, path: str, language: str = DEFAULT_LANGUAGE) -> bytes:
    """A file's content as it was ingested: of several the lowest id; an error if there is none."""
    share_code(content.sparkSession)
    hit = content.where(F.col("path") == path).join(F.broadcast(languages.where(F.col("value") == language).select(F.col("id").alias("languageID"))), "languageID").orderBy("id").limit(1)
    rows = hit.select(codec.decoded(F.col("content"), F.col("compression")).alias("content")).collect()
    if not rows:
        raise FileNotFoundError(f"{path} ({language})")
    return bytes(rows[0].content)


def violations(rows: DataFrame, not_null: list[str], keys: list[str], foreign: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(rule, n): rows with nulls by column, keys held more than once, and references without a target."""
    out = rows.select(*(F.count_if(F.col(c).isNull()).alias(c) for c in not_null)).unpivot([], not_null, "rule", "n").withColumn("rule", F.concat(F.lit("not_null:"), F.col("rule")))
    doubled = rows.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("n")).select(F.lit(f"unique:{','.join(keys)}").alias("rule"), "n")
    out = out.unionByName(doubled)
    for column, (target, key) in foreign.items():
        lost = rows.where(F.col(column).isNotNull()).join(target.select(F.col(key).alias(column)).distinct(), column, "left_anti").agg(F.count("*").alias("n"))
        out = out.unionByName(lost.select(F.lit(f"foreign_key:{column}").alias("rule"), "n"))
    return out


def lookup_or_reject(rows: DataFrame, column: str, table: DataFrame, value: str = "value", id_: str = "id") -> DataFrame:
    """``rows`` with the id of a looked-up value, and whether it is unknown."""
    ids = table.select(F.col(value).alias(column), F.col(id_).alias(f"{column}_id"))
    return rows.join(F.broadcast(ids), column, "left").withColumn("unknown", F.col(f"{column}_id").isNull())


def accepts(content_type: Column) -> Column:
    """Whether a store has the type."""
    return content_type.isin(*mime.CONTENT_TYPES)
