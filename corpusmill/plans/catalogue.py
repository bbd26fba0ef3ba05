"""The registered queries of the documentation-store engine and their DuckDB counterparts.

``pages`` stand for HTML files (their url gives the path), ``documents`` for text files; ``region``, ``nation`` and
``supplier`` form a table of contents. Each query runs its operator over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import codec, html, mime, paths
from corpusmill.operators import analysis, documents, links, serve, store, toc, tooltips
from corpusmill.session import scratch, share_code, table
from corpusmill.sources import files
from corpusmill.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Adds a query under its function's name, with its SQL if there is one."""

    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            ORACLES[query.__name__] = sql
        return query

    return add


# shared shapes ------------------------------------------------------------------------------------------------------

SITE_PATH_SQL = r"regexp_replace(regexp_replace(url, '[#?].*$', ''), '^[a-z]+://', '')"
LOCAL_PATH_SQL = r"regexp_extract(url, '://[^/]*(/[^?#]*)', 1)"
SUFFIX_SQL = r"regexp_extract(regexp_extract({0}, '[^/]*$'), '^[.]*[^.].*([.][^.]*)$', 1)"
NO_CODE_SQL = r"regexp_replace(html, '(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>', '', 'g')"
HREFS_SQL = rf"""SELECT page_id, unnest(range(len(l))) AS ord, unnest(l) AS url
  FROM (SELECT page_id, regexp_extract_all({NO_CODE_SQL}, '<a\s[^>]*?href="([^"]+)"', 1) AS l FROM pages)"""


def site_path(url: Column) -> Column:
    """Host and path of a page's url."""
    return F.regexp_replace(F.regexp_replace(url, r"[#?].*$", ""), "^[a-z]+://", "")


def local_path(url: Column) -> Column:
    return F.regexp_extract(url, r"://[^/]*(/[^?#]*)", 1)


def page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, path, html)."""
    return table(spark, sf_dir, "pages").select("page_id", site_path(F.col("url")).alias("path"), "html")


def text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, text, lang, source)."""
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("docs/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text", "lang", "source")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.quick_hrefs(table(spark, sf_dir, "pages"), "page_id").withColumn("ord", F.col("ord").cast("long"))


def cycle(key: str, *values: str) -> Column:
    """A constant chosen by the key."""
    return F.array(*map(F.lit, values))[(F.col(key) % len(values)).cast("int")]


def cycle_sql(key: str, *values: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST({key} % {len(values)} AS INT) + 1]"


# store --------------------------------------------------------------------------------------------------------------

_TYPES_SQL = "(VALUES " + ", ".join(f"('{s}', '{t}')" for s, t in sorted(mime.mime_map().items()) if t in mime.CONTENT_TYPES) + ") m(suffix, content_type)"


@register(f"""
SELECT content_type, count(*) AS files
FROM (SELECT coalesce(nullif({SUFFIX_SQL.format(SITE_PATH_SQL)}, ''), '.html') AS suffix FROM pages) p JOIN {_TYPES_SQL} USING (suffix)
GROUP BY content_type""")
def content_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by content type (D2, E1, E2); names without suffix are HTML."""
    types = mime.content_types(spark)
    named = table(spark, sf_dir, "pages").select(F.coalesce(F.nullif(paths.suffix(site_path(F.col("url"))), F.lit("")), F.lit(".html")).alias("suffix"))
    typed = named.join(F.broadcast(mime.mime_table(spark)), "suffix").join(F.broadcast(types.select(F.col("value").alias("content_type"), F.col("id").alias("contentTypeID"))), "content_type")
    return store.summary(typed.drop("content_type"), types)


@register("SELECT 'docs/' || source || '/' || doc_id || '.txt' AS path, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")
def content_list_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path and stored bytes."""
    return store.list_documents(text_files(spark, sf_dir).withColumn("content", F.encode("text", "utf-8")))


@register("SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS input_bytes, CAST(sum(strlen(text)) AS BIGINT) AS stored_bytes, CAST(0 AS DOUBLE) AS percent_saved FROM documents")
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a store without compression."""
    rows = text_files(spark, sf_dir).select(F.encode("text", "utf-8").alias("content"), F.octet_length("text").alias("input_bytes"))
    return store.stats(rows)


@register("SELECT count(*) AS files, CAST(sum(strlen(text)) AS BIGINT) AS input_bytes, true AS smaller, true AS share_fits FROM documents")
def store_stats_compressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with content encoded by its type's policy."""
    share_code(spark)
    rows = text_files(spark, sf_dir).select(codec.compress(F.encode("text", "utf-8"), F.lit(codec.COMPRESSED)).alias("content"), F.octet_length("text").alias("input_bytes"))
    share = 100 * (1 - F.col("stored_bytes") / F.col("input_bytes"))
    return store.stats(rows).select("files", "input_bytes", ((F.col("stored_bytes") > 0) & (F.col("stored_bytes") < F.col("input_bytes"))).alias("smaller"), (F.abs(F.col("percent_saved") - share) < 0.01).alias("share_fits"))


@register("SELECT count(*) AS files, count(*) AS intact FROM documents WHERE text IS NOT NULL")
def codec_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content that is the same after encoding and decoding."""
    share_code(spark)
    rows = text_files(spark, sf_dir).where("text is not null").select(F.encode("text", "utf-8").alias("content"))
    back = codec.decompress(codec.compress(F.col("content"), F.lit(codec.COMPRESSED)), F.lit(codec.COMPRESSED))
    return rows.agg(F.count("*").alias("files"), F.count_if(back == F.col("content")).alias("intact"))


_SUFFIXES = (".html", ".txt", ".png", ".xml", ".ico", ".HTML", ".jhm", ".rdf", "", ".svg", ".md")


@register(f"""
SELECT suffix, reject_reason, count(*) AS files FROM (
  SELECT {cycle_sql("page_id", *_SUFFIXES)} AS suffix,
         {cycle_sql("page_id", "", "", "invalid_image", "unknown_type", "unknown_type", "unknown_extension", "unknown_extension", "xml", "unknown_extension", "", "")} AS reason,
         CASE WHEN page_id % 13 = 0 THEN 'unknown_language' ELSE nullif(reason, '') END AS reject_reason
  FROM pages) GROUP BY suffix, reject_reason""")
def ingest_accept_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted files and rejects by first reason."""
    pages = table(spark, sf_dir, "pages").select(F.concat(F.lit("p"), F.col("page_id").cast("string"), cycle("page_id", *_SUFFIXES)).alias("path"), F.when(F.col("page_id") % 13 == 0, "xx").otherwise(store.DEFAULT_LANGUAGE).alias("language"), F.encode("html", "utf-8").alias("content"))
    languages = spark.createDataFrame([(1, store.DEFAULT_LANGUAGE)], "id long, value string")
    judged = store.classify(pages, languages, mime.mime_table(spark), mime.content_types(spark))
    return judged.groupBy("suffix", "reject_reason").agg(F.count("*").alias("files"))


_PREFIXES = ("../../", "./", "", "/", "../SourceDocs/", "SourceDocs/", ".././SourceDocs/SourceDocs/")


@register(rf"""
SELECT page_id, regexp_replace(regexp_replace({cycle_sql("page_id", *_PREFIXES)} || {SITE_PATH_SQL}, '^([.][.]/|[.]/)+', ''), '^SourceDocs/', '') AS path FROM pages""")
def path_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths as the store spells them."""
    return page_files(spark, sf_dir).select("page_id", paths.normalize_path(F.concat(cycle("page_id", *_PREFIXES), F.col("path"))).alias("path"))


@register(rf"""
SELECT page_id, regexp_extract(p, '[^/]*$') AS base, regexp_replace(p, '/?[^/]*$', '') AS folder, {SUFFIX_SQL.format("p")} AS suffix,
       CASE WHEN position('.' IN regexp_extract(p, '[^/]*$')) > 0 THEN regexp_extract(regexp_extract(p, '[^/]*$'), '[^.]*$') END AS extension
FROM (SELECT page_id, {SITE_PATH_SQL} AS p FROM pages)""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base name, folder, suffix and extension."""
    p = F.col("path")
    return page_files(spark, sf_dir).select("page_id", paths.basename(p).alias("base"), paths.dirname(p).alias("folder"), paths.suffix(p).alias("suffix"), paths.extension(p).alias("extension"))


@register("SELECT page_id, 'site/' || page_id || '/x.html' AS target FROM pages")
def path_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative paths seen from a folder."""
    key = F.col("page_id").cast("string")
    return table(spark, sf_dir, "pages").select("page_id", paths.resolve(F.lit("site/a/b"), F.concat(F.lit("../.././"), key, F.lit("//y/../x.html"))).alias("target"))


@register("SELECT 'd' || doc_id % 97 AS path, min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY ALL")
def ingest_dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first file of a path."""
    rows = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), (F.col("doc_id") % 97).cast("string")).alias("path"), "doc_id", "lang")
    return store.first_per_key(rows, ["path"], "doc_id")


@register("SELECT lang AS category, source AS tag, max(doc_id) AS seq, arg_max(CAST(strlen(text) AS BIGINT), doc_id) AS bytes FROM documents GROUP BY ALL")
def tooltip_upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of inserts or replacements by key (B2, L3)."""
    rows = table(spark, sf_dir, "documents").select(F.col("lang").alias("category"), F.col("source").alias("tag"), F.col("doc_id").alias("seq"), F.octet_length("text").cast("long").alias("bytes"))
    return store.last_per_key(rows, ["category", "tag"], "seq")


@register("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS id FROM orders")
def dense_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids in path order without a single-task sort."""
    return store.with_ids(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 1).select("o_orderkey", F.col("id").cast("long").alias("id"))


@register("SELECT lang, CASE lang WHEN 'de' THEN 1 WHEN 'en' THEN 2 WHEN 'fr' THEN 3 END AS lang_id, lang NOT IN ('de', 'en', 'fr') AS unknown, count(*) AS n FROM documents GROUP BY ALL")
def language_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language ids, and languages that are unknown (D3)."""
    known = spark.createDataFrame([(1, "de"), (2, "en"), (3, "fr")], "id long, value string")
    return store.lookup_or_reject(table(spark, sf_dir, "documents").select("lang"), "lang", known).groupBy("lang", "lang_id", "unknown").agg(F.count("*").alias("n"))


@register("""
SELECT 'not_null:o_custkey' AS rule, count(*) FILTER (o_custkey IS NULL) AS n FROM orders
UNION ALL SELECT 'not_null:o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'unique:o_custkey,o_orderdate', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key:o_custkey', count(*) FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c_acctbal > 0)""")
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of NOT NULL, UNIQUE and references."""
    customers = table(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    return store.violations(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"], ["o_custkey", "o_orderdate"], {"o_custkey": (customers, "c_custkey")})


@register("SELECT id, value, compression FROM (VALUES " + ", ".join(f"({i}, '{t}', '{'none' if t in ('image/jpeg', 'image/png', 'image/gif', 'font/ttf') else 'brotli'}')" for i, t in enumerate(mime.CONTENT_TYPES, 1)) + ") t(id, value, compression)")
def type_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared compression of each type."""
    return mime.content_types(spark).select(F.col("id").cast("int").alias("id"), "value", mime.policy(F.col("value")).alias("compression"))


_PNG = "89504E470D0A1A0A0000000D4948445200000001000000010806000000{}0000000049454E44AE426082"


@register("SELECT doc_id, doc_id % 4 = 0 AS png FROM documents")
def png_magic_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether bytes are a PNG file."""
    head = cycle("doc_id", _PNG, "FFD8FFE000104A464946", _PNG.replace("49484452", "49484453"), _PNG[:60])
    return table(spark, sf_dir, "documents").select("doc_id", codec.is_png(F.unhex(F.replace(head, F.lit("{}"), F.lpad(F.hex("doc_id"), 8, "0")))).alias("png"))


@register("SELECT 100 AS files, 100 AS names, 100 AS of_known_kinds, 0 AS without_content")
def synthetic_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Made-up files."""
    known = F.col("path").rlike("^file[0-9]+[.](html|txt|css|md|json|js)$")
    return files.synthetic(spark).agg(F.count("*").alias("files"), F.countDistinct("path").alias("names"), F.count_if(known).alias("of_known_kinds"), F.count_if(F.octet_length("content") == 0).alias("without_content"))


_INGEST_SQL = """
WITH f AS (
  SELECT page_id, page_id // 3 AS k, (['../', './', ''])[CAST(page_id % 3 AS INT) + 1] AS up,
         'p' || page_id // 3 || CASE WHEN page_id // 3 % 5 = 1 THEN '.txt' WHEN page_id // 3 % 5 = 2 THEN '.log' ELSE '.png' END AS path,
         CASE WHEN page_id // 3 % 5 = 2 THEN 'unknown_extension' WHEN page_id // 3 % 5 <> 1 AND page_id % 3 = 0 AND page_id // 3 % 2 = 0 THEN 'invalid_image' END AS bad
  FROM pages),
r AS (SELECT *, row_number() OVER (PARTITION BY path, bad IS NULL ORDER BY up || path) AS n FROM f)
SELECT up || path AS source, path, coalesce(bad, CASE WHEN n > 1 THEN 'duplicate' END) AS reject_reason, CASE WHEN bad IS NULL AND n = 1 THEN page_id END AS page_id FROM r"""


@register(_INGEST_SQL)
def ingest_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's own ingest, read back: rejects, first acceptable file of a path, content."""
    share_code(spark)
    home = scratch(spark, "store")
    k, which = F.floor(F.col("page_id") / 3), F.floor(F.col("page_id") / 3) % 5
    path = F.concat(F.element_at(F.array(*map(F.lit, ("../", "./", ""))), (F.col("page_id") % 3 + 1).cast("int")), F.lit("p"), k.cast("string"), F.when(which == 1, ".txt").when(which == 2, ".log").otherwise(".png"))
    picture = F.unhex(F.replace(F.lit(_PNG), F.lit("{}"), F.lpad(F.hex("page_id"), 8, "0")))
    bad = (F.col("page_id") % 3 == 0) & (k % 2 == 0)
    content = F.when(which == 1, F.encode(F.concat(F.repeat(F.lit("text "), 50), F.col("page_id").cast("string")), "utf-8")).when(bad, F.encode(F.lit("none"), "utf-8")).otherwise(picture)
    rows = table(spark, sf_dir, "pages").select("page_id", path.alias("path"), content.alias("content"))
    store.ingest(spark, rows.where(k % 2 == 0), home)
    store.ingest(spark, rows.where(k % 2 == 1), home)  # two batches, one store
    held = store.read(spark, home, "Content")
    plain = codec.decoded(F.col("content"), F.col("compression"))
    digits = F.when(F.col("path").endswith(".txt"), F.regexp_extract(F.decode(plain, "utf-8"), "([0-9]+)$", 1).cast("long")).otherwise(F.conv(F.hex(F.substring(plain, 30, 4)), 16, 10).cast("long"))
    found = held.select("path", digits.alias("page_id"))
    own = F.when(F.col("reject_reason").isNull(), F.col("page_id"))
    return spark.read.parquet(f"{home}/_reports/*").join(found, "path", "left").select("source", "path", "reject_reason", own.alias("page_id"))


# serving ------------------------------------------------------------------------------------------------------------


@register(f"""
WITH content AS (SELECT {SITE_PATH_SQL} AS path, count(*) AS matches FROM pages GROUP BY 1),
requests AS (SELECT page_id AS request_id, {SITE_PATH_SQL} || CASE WHEN page_id % 5 = 0 THEN 'x' ELSE '' END AS path, CASE WHEN page_id % 3 = 0 THEN 'de' ELSE 'en-US' END AS language FROM pages)
SELECT request_id, path, language, CASE WHEN language = 'de' OR matches IS NULL THEN 404 WHEN matches = 1 THEN 200 ELSE 500 END AS status
FROM requests LEFT JOIN content USING (path)""")
def serve_lookup_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of lookups by path and language."""
    content = page_files(spark, sf_dir).select(F.col("page_id").alias("id"), "path", F.lit(1).cast("long").alias("languageID"), F.encode("html", "utf-8").alias("content"), F.lit(1).cast("long").alias("contentTypeID"), F.lit("none").alias("compression"))
    languages = spark.createDataFrame([(1, store.DEFAULT_LANGUAGE), (2, "de")], "id long, value string")
    types = spark.createDataFrame([(1, "text/html")], "id long, value string")
    asked = page_files(spark, sf_dir).select(F.col("page_id").alias("request_id"), F.concat(F.lit("/"), F.col("path"), F.when(F.col("page_id") % 5 == 0, "x").otherwise("")).alias("url"), F.when(F.col("page_id") % 3 == 0, "de, en-US;q=0.5").alias("accept_language"), F.lit("gzip").alias("accept_encoding"))
    return serve.resolve(asked, content, languages, types).select("request_id", "path", "language", "status")


@register(f"""
SELECT page_id AS request_id, 200 AS status, 'text/html' AS content_type, CASE WHEN page_id % 3 = 0 THEN 'deflate' END AS content_encoding,
       CASE WHEN page_id % 3 <> 0 THEN CAST(strlen(html) AS BIGINT) END AS plain_length, md5(html) AS body_md5
FROM pages
UNION ALL SELECT -1 - page_id, 404, 'text/html', NULL, NULL, 'p/none' || page_id FROM pages WHERE page_id % 10 = 0""")
def serve_respond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses to lookups by unique paths, as stored or decoded."""
    share_code(spark)
    pages = table(spark, sf_dir, "pages")
    key = F.concat(F.lit("p/"), F.col("page_id").cast("string"))
    content = pages.select(F.col("page_id").alias("id"), key.alias("path"), F.lit(1).cast("long").alias("languageID"), codec.compress(F.encode("html", "utf-8"), F.lit("deflate")).alias("content"), F.lit(1).cast("long").alias("contentTypeID"), F.lit("deflate").alias("compression"))
    languages = spark.createDataFrame([(1, store.DEFAULT_LANGUAGE)], "id long, value string")
    types = spark.createDataFrame([(1, "text/html")], "id long, value string")
    asked = pages.select(F.col("page_id").alias("request_id"), F.concat(F.lit("/"), key).alias("url"), F.lit(None).cast("string").alias("accept_language"), cycle("page_id", "gzip, deflate ,br", "gzip", "deflate;q=0").alias("accept_encoding"))
    lost = pages.where("page_id % 10 = 0").select((-1 - F.col("page_id")).alias("request_id"), F.concat(F.lit("/p/none"), F.col("page_id").cast("string")).alias("url"), F.lit(None).cast("string").alias("accept_language"), F.lit(None).cast("string").alias("accept_encoding"))
    done = serve.respond(serve.resolve(asked.unionByName(lost), content, languages, types))
    found, packed = F.col("status") == 200, F.col("content_encoding").isNotNull()
    body = F.when(found, F.md5(F.when(packed, codec.decompress(F.col("body"), F.coalesce("content_encoding", F.lit("none")))).otherwise(F.col("body")))).otherwise(F.regexp_extract(F.decode("body", "utf-8"), "(p/none[0-9]+)", 1))
    return done.select("request_id", "status", "content_type", "content_encoding", F.when(found & ~packed, F.col("content_length")).alias("plain_length"), body.alias("body_md5"))


_ENCODINGS = ("br", "gzip, br", "gzip,deflate", "br;q=1", "*", "deflate , br ")


@register(f"""
SELECT conv_id, turn, trim(string_split(coalesce(CASE WHEN turn % 3 = 0 THEN NULL ELSE role || ' , en;q=0.5' END, 'en-US'), ',')[1]) AS language,
       list_contains(list_transform(string_split({cycle_sql("conv_id", *_ENCODINGS)}, ','), lambda x: trim(x)), 'br') AS brotli
FROM conversations""")
def serve_negotiate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and encoding that a client accepts."""
    spoken = F.when(F.col("turn") % 3 != 0, F.concat(F.col("role"), F.lit(" , en;q=0.5")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", serve.language_of(spoken).alias("language"), serve.accepts_encoding(cycle("conv_id", *_ENCODINGS)).alias("brotli"))


# links --------------------------------------------------------------------------------------------------------------


@register(HREFS_SQL)
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All links in document order, repeats included."""
    return page_links(spark, sf_dir)


@register(rf"SELECT page_id, ord, 'a' AS tag, 'href' AS attr, url FROM ({HREFS_SQL})")
def link_attrs_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All href and src of any tag by a real parse."""
    return links.extract(table(spark, sf_dir, "pages"), "page_id", tags=None, attrs=("href", "src"))


_STATUS_SQL = rf"""SELECT page_id, ord, url, CASE WHEN regexp_matches(lower(url), '^(https?|mailto):') THEN 'external'
       WHEN regexp_replace(url, '[#?].*$', '') = '' THEN 'valid'
       WHEN rtrim(regexp_replace(url, '[#?].*$', ''), '/') IN (SELECT rtrim({LOCAL_PATH_SQL}, '/') FROM pages) THEN 'valid' ELSE 'broken' END AS status
  FROM (SELECT page_id, ord, url FROM ({HREFS_SQL}) UNION ALL SELECT page_id, -1, {LOCAL_PATH_SQL} || '?q#f' FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT page_id, -2, upper(url) FROM pages)"""


def _link_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    own = pages.where("page_id % 2 = 0").select("page_id", F.lit(-1).cast("long").alias("ord"), F.concat(local_path(F.col("url")), F.lit("?q#f")).alias("url"))
    away = pages.select("page_id", F.lit(-2).cast("long").alias("ord"), F.upper("url").alias("url"))
    found = page_links(spark, sf_dir).unionByName(own).unionByName(away).withColumn("file", F.lit("/x/index.html"))
    return links.audit(found, pages.select(local_path(F.col("url")).alias("path"))).select("page_id", "ord", "url", "status")


@register(_STATUS_SQL)
def link_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that lead outside, to what is there, or nowhere."""
    return _link_status(spark, sf_dir)


@register(f"SELECT status, count(*) AS n FROM ({_STATUS_SQL}) GROUP BY status")
def link_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links by status."""
    return _link_status(spark, sf_dir).groupBy("status").agg(F.count("*").alias("n"))


_MAP_SQL = f"url_map AS (SELECT url, 'docs/' || max(page_id) AS file FROM ({HREFS_SQL}) WHERE page_id % 2 = 0 GROUP BY url)"


def _classified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    found = page_links(spark, sf_dir)
    url_map = found.where("page_id % 2 = 0").groupBy("url").agg(F.concat(F.lit("docs/"), F.max("page_id").cast("string")).alias("file"))
    return links.classify(found, url_map)


@register(f"WITH {_MAP_SQL} SELECT page_id, ord, url FROM ({HREFS_SQL}) WHERE url IN (SELECT url FROM url_map)")
def link_valid_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in the url map."""
    return _classified(spark, sf_dir)[0].select("page_id", "ord", "url")


@register(f"WITH {_MAP_SQL} SELECT page_id, ord, url FROM ({HREFS_SQL}) WHERE url NOT IN (SELECT url FROM url_map)")
def link_invalid_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links not in the url map."""
    return _classified(spark, sf_dir)[1].select("page_id", "ord", "url")


@register(f"WITH {_MAP_SQL} SELECT page_id, ord, url, file FROM ({HREFS_SQL}) JOIN url_map USING (url)")
def link_target_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with the files they lead to."""
    return _classified(spark, sf_dir)[2].select("page_id", "ord", "url", "file")


@register(f"SELECT page_id, ord, 'https://developer.android.com' || url AS absolute FROM ({HREFS_SQL})")
def link_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links resolved against a site."""
    share_code(spark)
    return page_links(spark, sf_dir).select("page_id", "ord", paths.absolute_url(F.col("url")).alias("absolute"))


_HREF_MIX_SQL = rf"SELECT page_id, CASE WHEN page_id % 4 = 0 THEN url ELSE regexp_extract(url, '://[^/]*(.*)$', 1) END AS href FROM pages"


def _mixed_hrefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 4 == 0, F.col("url")).otherwise(F.regexp_extract("url", r"://[^/]*(.*)$", 1)).alias("href"))


@register(f"SELECT page_id, href, CASE WHEN href LIKE 'http://%' OR href LIKE 'https://%' THEN href ELSE replace(regexp_replace(href, '^/', ''), '/', '_') || '.html' END AS local FROM ({_HREF_MIX_SQL})")
def menu_href_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu links as flat names."""
    return _mixed_hrefs(spark, sf_dir).select("page_id", "href", paths.menu_href(F.col("href")).alias("local"))


_ARTICLE_HREF_SQL = rf"""CASE WHEN href LIKE 'http://%' OR href LIKE 'https://%' THEN href
  ELSE replace(regexp_replace(regexp_replace(href, '[#?].*$', ''), '^/', ''), '/', '_') || '.html' || CASE WHEN regexp_extract(href, '#(.*)$', 1) <> '' THEN '#' || regexp_extract(href, '#(.*)$', 1) ELSE '' END END"""


@register(rf"""
WITH r AS (SELECT page_id, href, {_ARTICLE_HREF_SQL} AS local FROM ({_HREF_MIX_SQL})),
made AS (SELECT DISTINCT regexp_replace(local, '#.*$', '') AS name FROM r WHERE page_id % 3 = 0)
SELECT page_id, href, local, CASE WHEN href LIKE 'http%://%' THEN 'external' WHEN regexp_replace(local, '#.*$', '') IN (SELECT name FROM made) THEN 'existing' ELSE 'non-existing' END AS linkstatus FROM r""")
def article_href_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article links as flat names, and whether their target is there."""
    rows = _mixed_hrefs(spark, sf_dir).withColumn("local", paths.article_href(F.col("href"))).withColumn("name", F.regexp_replace("local", "#.*$", ""))
    made = rows.where("page_id % 3 = 0").select("name").distinct().withColumn("there", F.lit(True))
    status = F.when(paths.is_absolute(F.col("href")), "external").when(F.col("there"), "existing").otherwise("non-existing")
    return rows.join(made, "name", "left").select("page_id", "href", "local", status.alias("linkstatus"))


_PAIRS_SQL = r"SELECT page_id AS line_no, regexp_replace(url, '[?#].*$', '') AS url, 'r' || page_id % 50 AS rid FROM pages"


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("line_no"), F.regexp_replace("url", "[?#].*$", "").alias("url"), F.concat(F.lit("r"), (F.col("page_id") % 50).cast("string")).alias("rid"))


@register(f"SELECT url, arg_max('/data/' || regexp_replace(replace(url, 'https://', ''), '/?[^/]*$', '') || '/' || rid, line_no) AS file FROM ({_PAIRS_SQL}) WHERE contains(regexp_replace(url, '^[a-z]+://', ''), '/') GROUP BY url")
def url_maps_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local files by url; the last line wins."""
    pairs = _pairs(spark, sf_dir).where(F.regexp_replace("url", "^[a-z]+://", "").contains("/"))
    return links.url_maps(pairs, "/data", "https://")[0]


@register(f"SELECT rid, arg_max(replace(replace(url, 'https://', ''), '/', '_'), line_no) AS file_key FROM ({_PAIRS_SQL}) GROUP BY rid")
def rid_map_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat names by resource id; the last line wins."""
    return links.url_maps(_pairs(spark, sf_dir), "/data", "https://")[1]


@register("SELECT arg_max(html, page_id) AS menu_html, 7 AS menu_id FROM pages WHERE page_id % 11 = 7 HAVING count(*) > 0")
def menu_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The menu of an id; of several the last."""
    cache = table(spark, sf_dir, "pages").select(F.col("page_id").alias("seq"), F.col("html").alias("menu_html"), (F.col("page_id") % 11).cast("int").alias("menu_id"))
    return links.menu_by_id(cache, 7)


@register(rf"""
SELECT page_id, src, CASE WHEN page_id % 3 = 0 THEN 'media/k' || page_id WHEN page_id % 3 = 1 THEN 'media/f' || page_id || '.png' END AS new_src
FROM (SELECT page_id, '/img/' || page_id AS src FROM pages)""")
def media_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures with the names they are copied to."""
    share_code(spark)
    key = F.col("page_id").cast("string")
    pages = table(spark, sf_dir, "pages")
    sources = pages.select("page_id", F.concat(F.lit("/img/"), key).alias("src"))
    url_map = pages.select(F.concat(F.lit(f"{paths.SITE_URL}img/"), key).alias("url"), F.concat(F.lit("raw/f"), key, F.lit(".png")).alias("file"))
    there = pages.where("page_id % 3 <> 2").select(F.concat(F.lit("raw/f"), key, F.lit(".png")).alias("path"))
    rids = pages.where("page_id % 3 = 0").select(F.concat(F.lit("f"), key, F.lit(".png")).alias("rid"), F.concat(F.lit("k"), key).alias("file_key"))
    return links.media_plan(sources, url_map, rids, there, "media").select("page_id", "src", "new_src")


# documents ----------------------------------------------------------------------------------------------------------


@register(r"SELECT page_id, md5(regexp_extract(html, '(?s)<article[^>]*>(.*?)</article>', 1)) AS article_md5 FROM pages")
def article_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first article."""
    return table(spark, sf_dir, "pages").select("page_id", F.md5(documents.article_text(F.col("html"))).alias("article_md5"))


@register(f"SELECT page_id, length({NO_CODE_SQL}) AS n_chars, md5({NO_CODE_SQL}) AS page_md5 FROM pages")
def strip_script_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without scripts and style sheets."""
    page = links.without_code(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(page).cast("long").alias("n_chars"), F.md5(page).alias("page_md5"))


@register(r"SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages")
def title_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles (J21)."""
    return table(spark, sf_dir, "pages").select("page_id", documents.title_text(F.col("html")).alias("title"))


@register(rf"SELECT tag, count(*) AS n FROM (SELECT unnest(regexp_extract_all({NO_CODE_SQL}, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM pages) GROUP BY tag")
def tag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags by number."""
    tags = F.regexp_extract_all(links.without_code(F.col("html")), F.lit("<([a-zA-Z][a-zA-Z0-9]*)"), F.lit(1))
    return table(spark, sf_dir, "pages").select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))


def _rich_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, path, html): pages whose articles also have links, code, navigation and pictures; some have no article."""
    key = F.col("page_id").cast("string")
    more = F.concat(F.lit('<div class="navigation-links b">n</div><a href="https://e.example/'), key, F.lit('">o</a><a href="/k/'), key, F.lit('?q#f" class="k" style="x;">i</a><a href="/'), (F.col("page_id") + 1).cast("string"), F.lit('?a=1&amp;b=2">j</a><div class="code-block x">c</div><img src="/img/'), key, F.lit('"><devsite-x>w</devsite-x></article>'))
    page = F.when(F.col("page_id") % 7 == 0, F.regexp_replace("html", "</?article>", "")).otherwise(F.replace(F.col("html"), F.lit("</article>"), more))
    return table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("site/"), key).alias("path"), page.alias("html"))


def _count(page: Column, part: str) -> Column:
    return F.size(F.regexp_extract_all(page, F.lit(part), F.lit(0)))


_PLAIN_SQL = "replace(regexp_replace({0}, '<[^>]*>', '', 'g'), '&amp;', '&')"


@register(rf"""
SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'raw' ELSE 'article' END AS status, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
       CASE WHEN page_id % 7 = 0 THEN 0 ELSE 1 END AS n_away, CASE WHEN page_id % 7 = 0 THEN 0 ELSE 1 END AS n_local, CASE WHEN page_id % 7 = 0 THEN 0 ELSE 1 END AS n_code, page_id % 7 = 0 AS code_left,
       md5(CASE WHEN page_id % 7 = 0 THEN {_PLAIN_SQL.format("regexp_extract(regexp_replace(html, '</?article>', '', 'g'), '(?s)<h1>.*', 0)")} ELSE {_PLAIN_SQL.format("regexp_extract(html, '(?s)<h1>.*</article>', 0)")} || 'oijcw' END) AS text_md5
FROM pages""")
def article_debloat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles cleaned and rewrapped, by what they hold."""
    done = documents.debloat_articles(_rich_pages(spark, sf_dir), "page_id")
    page = F.col("clean")
    text = F.replace(F.regexp_replace(F.regexp_extract(page, "(?s)<h1>.*", 0), "<[^>]*>", ""), F.lit("&amp;"), F.lit("&"))
    return done.select(
        "page_id",
        "status",
        documents.title_text(page).alias("title"),
        _count(page, r'<a href="https://e[.]example/[0-9]+" style="color: red !important;">').alias("n_away"),
        _count(page, r'<a href="/k/[0-9]+\?q#f" class="k" style="x;color: blue !important;">').alias("n_local"),
        _count(page, '<div class="code-block x" style="font-family: monospace').alias("n_code"),
        (page.contains("<script") | page.contains("<style")).alias("code_left"),
        F.md5(F.encode(text, "utf-8")).alias("text_md5"),
    )


@register("""
SELECT page_id, page_id || '.html' AS output_name, page_id % 7 <> 0 AS has_article,
       CASE WHEN page_id % 7 <> 0 THEN 1 END AS n_external, CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id + 1 IN (SELECT page_id FROM pages) THEN 1 ELSE 0 END END AS n_existing,
       CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id + 1 IN (SELECT page_id FROM pages) THEN 1 ELSE 2 END END AS n_missing,
       CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END END AS n_pictures, CASE WHEN page_id % 7 <> 0 THEN CASE WHEN page_id % 2 = 0 THEN 0 ELSE 1 END END AS n_crosses,
       CASE WHEN page_id % 7 <> 0 THEN 'k_' || page_id || '.html#f|' || (page_id + 1) || '.html' END AS locals, CASE WHEN page_id % 7 <> 0 THEN false END AS widget_left
FROM pages""")
def site_debloat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site's articles with local links and media, by what they hold."""
    pages = _rich_pages(spark, sf_dir)
    key = F.col("page_id").cast("string")
    media = pages.where("page_id % 2 = 0").select("path", F.concat(F.lit("/img/"), key).alias("src"), F.concat(F.lit("media/m"), key).alias("new_src"))
    page = F.col("clean")
    locals_ = F.array_join(F.regexp_extract_all(page, F.lit('<a href="([^"]*)"[^>]* linkstatus='), F.lit(1)), "|")
    return documents.debloat_site(pages, media, "menu.html").select(
        F.regexp_extract("path", "[0-9]+$", 0).cast("long").alias("page_id"),
        "output_name",
        page.isNotNull().alias("has_article"),
        *(_count(page, f'class="[^"]*{kind}"').alias(name) for kind, name in (("\\bexternal", "n_external"), ("(?<!-)existing", "n_existing"), ("non-existing", "n_missing"))),
        _count(page, '<img src="media/m[0-9]+"').alias("n_pictures"),
        _count(page, "<svg").alias("n_crosses"),
        locals_.alias("locals"),
        page.contains("devsite").alias("widget_left"),
    )


@register(rf"""
SELECT page_id, len(l) AS n_links, coalesce(array_to_string(list_transform(l, lambda x: CASE WHEN x LIKE 'http://%' OR x LIKE 'https://%' THEN x ELSE replace(regexp_replace(x, '^/', ''), '/', '_') || '.html' END), '|'), '') AS links, 0 AS n_other
FROM (SELECT page_id, regexp_extract_all({NO_CODE_SQL}, '<a\s[^>]*?href="([^"]+)"', 1) AS l FROM pages)""")
def menu_strip_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menus without attributes, by the links they keep."""
    done = documents.rewrite(table(spark, sf_dir, "pages"), "page_id", "html", documents.menu_only)
    page = links.without_code(F.col("clean"))
    kept = F.regexp_extract_all(page, F.lit('<a href="([^"]*)">'), F.lit(1))
    return done.select("page_id", F.size(kept).alias("n_links"), F.array_join(kept, "|").alias("links"), (_count(page, "<[a-z][a-z0-9-]* [^>]*>") - F.size(kept)).alias("n_other"))


# analysis -----------------------------------------------------------------------------------------------------------

_EXT_SQL = rf"SELECT page_id, {SITE_PATH_SQL} AS p, CASE WHEN position('.' IN regexp_extract(p, '[^/]*$')) > 0 THEN regexp_extract(regexp_extract(p, '[^/]*$'), '[^.]*$') ELSE 'None' END AS file_extension, strlen(html) AS size FROM pages"


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_files(spark, sf_dir).select("page_id", F.col("path").alias("file_name"), paths.extension(F.col("path")).alias("file_extension"), F.octet_length("html").alias("file_size"))


@register(f"SELECT file_extension, count(*) AS num_files, CAST(min(size) AS BIGINT) AS min_file_size, CAST(floor(avg(size)) AS BIGINT) AS mean_file_size, CAST(max(size) AS BIGINT) AS max_file_size, CAST(sum(size) AS BIGINT) AS total_size FROM ({_EXT_SQL}) GROUP BY file_extension")
def ext_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes by extension."""
    return analysis.by_extension(_inventory(spark, sf_dir))


@register(f"SELECT file_extension, array_to_string(list_sort(list_distinct(list(replace(p, 'example.', '')))), '|') AS names FROM ({_EXT_SQL}) GROUP BY file_extension")
def ext_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names by extension."""
    return analysis.names_by_extension(_inventory(spark, sf_dir), "example.").select("file_extension", F.array_join("file_names", "|").alias("names"))


@register(f"SELECT file_extension, min(page_id) AS first_seen FROM ({_EXT_SQL}) GROUP BY file_extension")
def extensions_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extensions by first appearance."""
    return analysis.extensions_in_order(_inventory(spark, sf_dir), "page_id")


@register(f"SELECT DISTINCT {SUFFIX_SQL.format(SITE_PATH_SQL)} AS suffix FROM pages WHERE suffix <> ''")
def suffix_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted distinct suffixes (G1)."""
    return store.suffixes(page_files(spark, sf_dir))[0]


_BY_SOURCE_SQL = "SELECT source, count(*) AS num_files, CAST(sum(strlen(text)) AS BIGINT) AS total_size FROM documents GROUP BY source"


def _by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("num_files"), F.sum(F.octet_length("text").cast("long")).alias("total_size"))


@register(f"{_BY_SOURCE_SQL} ORDER BY total_size DESC, source")
def size_by_ext_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups by falling size."""
    return _by_source(spark, sf_dir).orderBy(F.desc("total_size"), "source")


@register(f"""
WITH s AS ({_BY_SOURCE_SQL}), least AS (SELECT avg(total_size) AS m FROM s),
n AS (SELECT CASE WHEN total_size < m THEN 'OTHER' ELSE source END AS label, total_size AS v, CASE WHEN total_size < m THEN source END AS member FROM s, least UNION ALL SELECT 'OTHER', 0, NULL)
SELECT label, CAST(sum(v) AS BIGINT) AS value, array_to_string(list_sort(list(member) FILTER (member IS NOT NULL)), '|') AS members FROM n GROUP BY label""")
def pie_other_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small groups folded into one."""
    sizes = _by_source(spark, sf_dir).withColumn("m", F.avg("total_size").over(Window.partitionBy()))  # aggregated rows, few
    folded = analysis.fold_small(sizes, "source", "total_size", F.col("m"))
    return folded.select("label", "value", F.when(F.size("members") > 0, F.array_join("members", "|")).alias("members"))


@register(f"SELECT source, total_size, round(total_size * 100.0 / sum(total_size) OVER (), 6) AS percent FROM ({_BY_SOURCE_SQL})")
def percent_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group's percentage (B13, 2.F)."""
    return analysis.shares(_by_source(spark, sf_dir).select("source", "total_size"), "total_size").withColumn("percent", F.round("percent", 6))


@register(f"SELECT count(*) AS files, CAST(sum(strlen(html)) AS BIGINT) AS total_size FROM pages")
def grand_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes."""
    return analysis.totals(_inventory(spark, sf_dir))


@register(rf"""
SELECT DISTINCT regexp_extract({SITE_PATH_SQL}, '[^/]*$') AS name FROM pages WHERE page_id % 2 = 0
EXCEPT SELECT regexp_extract({SITE_PATH_SQL}, '[^/]*$') FROM pages WHERE page_id % 3 = 0""")
def html_set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of one corpus that another has not (H1, H2)."""
    names = page_files(spark, sf_dir).select("page_id", paths.basename(F.col("path")).alias("name"))
    return analysis.names_only_in(names.where("page_id % 2 = 0"), names.where("page_id % 3 = 0"))


@register("SELECT contains(t, 'You will be redirected') AS is_redirect, count(*) AS files, CAST(sum(length(t)) AS BIGINT) AS characters FROM (SELECT text || CASE WHEN doc_id % 7 = 0 THEN ' You will be redirected' ELSE '' END AS t FROM documents) GROUP BY 1")
def redirect_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redirect stubs and others."""
    return analysis.redirects(table(spark, sf_dir, "documents").select(F.concat("text", F.when(F.col("doc_id") % 7 == 0, " You will be redirected").otherwise("")).alias("text")))


# tables of contents -------------------------------------------------------------------------------------------------

_TOC_SQL = """RECURSIVE e AS (
  SELECT 'r' || r_regionkey AS id, r_name AS title, NULL AS url, 0 AS level, NULL AS parentId, true AS pages, r_regionkey AS tab, r_regionkey AS seq FROM region
  UNION ALL SELECT 'n' || n_nationkey, n_name, 'https://example.org/' || n_nationkey, 1, 'r' || n_regionkey, NULL, n_nationkey % 3, 100 + n_nationkey FROM nation
  UNION ALL SELECT 's' || s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || '.html' END, 2, 'n' || s_nationkey, NULL, 0, 1000 + s_suppkey FROM supplier),
k AS (SELECT *, lpad(CAST(row_number() OVER (PARTITION BY parentId ORDER BY tab, seq) AS VARCHAR), 12, '0') AS nth FROM e),
roots AS (SELECT 'r' || r_regionkey AS rid, lpad(CAST(4 - r_regionkey AS VARCHAR), 12, '0') AS pos FROM region WHERE r_regionkey < 4),
flat AS (
  SELECT id, title, url, level, parentId, pages, 0 AS depth, pos AS sort_path FROM k JOIN roots ON id = rid
  UNION ALL SELECT k.id, k.title, k.url, k.level, k.parentId, k.pages, flat.depth + 1, flat.sort_path || '/' || k.nth FROM flat JOIN k ON k.parentId = flat.id)"""


def _toc(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    key = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    none = F.lit(None).cast("string")
    columns = lambda id_, title, url, level, parent, pages, tab, seq: [id_.alias("id"), F.col(title).alias("title"), url.alias("url"), F.lit(level).alias("level"), parent.alias("parentId"), pages.cast("array<string>").alias("pages"), tab.cast("int").alias("tabIndex"), seq.cast("long").alias("seq")]
    entries = region.select(*columns(key("r", "r_regionkey"), "r_name", none, 0, none, F.array(F.lit("x")), F.col("r_regionkey"), F.col("r_regionkey")))
    entries = entries.unionByName(nation.select(*columns(key("n", "n_nationkey"), "n_name", F.concat(F.lit("https://example.org/"), F.col("n_nationkey").cast("string")), 1, key("r", "n_regionkey"), F.lit(None), F.col("n_nationkey") % 3, F.col("n_nationkey") + 100)))
    entries = entries.unionByName(supplier.select(*columns(key("s", "s_suppkey"), "s_name", F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.col("s_suppkey").cast("string"), F.lit(".html"))), 2, key("n", "s_nationkey"), F.lit(None), F.lit(None), F.col("s_suppkey") + 1000)))
    roots = region.where("r_regionkey < 4").select((4 - F.col("r_regionkey")).alias("pos"), key("r", "r_regionkey").alias("id"))
    return entries, roots


@register(f"WITH {_TOC_SQL} SELECT id, depth, row_number() OVER (ORDER BY sort_path) AS position FROM flat")
def toc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries in display order."""
    return toc.positions(toc.flatten(*_toc(spark, sf_dir))).select("id", "depth", F.col("position").cast("long").alias("position"))


@register(f"""WITH {_TOC_SQL} SELECT id AS data_id, level AS data_level, coalesce(parentId, '') AS data_parent,
  CASE WHEN pages OR url IS NULL THEN 'heading' WHEN url LIKE 'http%' THEN 'external' ELSE 'page' END AS entry_type,
  CASE WHEN level <> 0 THEN 'hidden' ELSE '' END || ' ' || entry_type AS class, level * 20 + 4 AS padding FROM flat""")
def toc_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of list items."""
    return toc.items(toc.flatten(*_toc(spark, sf_dir))).select("data_id", "data_level", "data_parent", "entry_type", "class", "padding")


@register(f"WITH {_TOC_SQL} SELECT a.id AS ancestor_id, d.id AS descendant_id FROM flat a JOIN flat d ON starts_with(d.sort_path, a.sort_path || '/')")
def toc_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What collapsing an entry hides."""
    return toc.descendants(toc.flatten(*_toc(spark, sf_dir)))


@register(f"WITH {_TOC_SQL} SELECT parentId AS parent_id, string_agg(id, '|' ORDER BY nth) AS child_ids FROM k WHERE parentId IS NOT NULL GROUP BY parentId")
def toc_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What expanding an entry shows."""
    return toc.children(_toc(spark, sf_dir)[0]).select("parent_id", F.array_join("child_ids", "|").alias("child_ids"))


@register(f"WITH {_TOC_SQL} SELECT id FROM e WHERE id NOT IN (SELECT id FROM flat)")
def toc_unreachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries below no root."""
    entries, roots = _toc(spark, sf_dir)
    return toc.unreachable(entries, toc.flatten(entries, roots)).select("id")


# tooltips -----------------------------------------------------------------------------------------------------------

_SHEET_SQL = """SELECT d.doc_id + 2 AS row_idx, CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE CAST(d.doc_id AS VARCHAR) END AS tag, lang AS category,
  CASE WHEN d.doc_id % 3 = 0 THEN '' ELSE 's' END AS summary, CAST(quality AS VARCHAR) AS b, 'u' AS u FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""
_REASON_SQL = "CASE WHEN coalesce(tag, '') IN ('', '0') THEN 'tag' WHEN coalesce(category, '') = '' THEN 'category' WHEN summary = '' THEN 'summary' WHEN coalesce(b, '') IN ('', '0') THEN 'buttonDescr1' END"


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return joined.select((F.col("doc_id") + 2).alias("row_idx"), F.when(F.col("doc_id") % 5 != 0, F.col("doc_id").cast("string")).alias("tag"), F.col("lang").alias("category"), F.when(F.col("doc_id") % 3 == 0, "").otherwise("s").alias("summary"), F.col("quality").cast("string").alias("buttonDescr1"), F.lit("u").alias("buttonURI1"))


@register(f"SELECT row_idx, 'Row ' || row_idx || ': empty ' || {_REASON_SQL} AS error FROM ({_SHEET_SQL}) WHERE {_REASON_SQL} IS NOT NULL")
def validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows with their reason."""
    return _sheet(spark, sf_dir).select("row_idx", tooltips.reject_reason(F.col("row_idx")).alias("error")).where("error is not null")


@register(f"SELECT count(*) AS total_rows, count(*) FILTER ({_REASON_SQL} IS NULL) AS processed_rows, count(*) FILTER ({_REASON_SQL} IS NOT NULL) AS skipped_rows FROM ({_SHEET_SQL})")
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read, processed and skipped."""
    error = tooltips.reject_reason(F.col("row_idx"))
    return _sheet(spark, sf_dir).agg(F.count("*").alias("total_rows"), F.count_if(error.isNull()).alias("processed_rows"), F.count_if(error.isNotNull()).alias("skipped_rows"))


@register("""SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 THEN p_name END AS first,
  CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 5 <> 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'http://localhost/docs/' ELSE 'https://else.example/' END || p_partkey || '.html' END AS second FROM part""")
def button_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buttons with moved urls; none without a description."""
    description = F.when(F.col("p_partkey") % 4 == 0, F.lit(None)).when(F.col("p_partkey") % 5 == 0, "False").otherwise(F.col("p_name"))
    uri = F.concat(F.when(F.col("p_partkey") % 2 == 0, "https://vendor.example/docs/").otherwise("https://else.example/"), F.col("p_partkey").cast("string"), F.lit(".html"))
    made = tooltips.button(description, paths.moved_url(uri, "https://vendor.example/docs/", "http://localhost/docs/"))
    parsed = F.from_json(tooltips.button_json(F.array(made)), f"array<{tooltips.BUTTON}>")[0]
    return table(spark, sf_dir, "part").select("p_partkey", parsed["first"].alias("first"), parsed["second"].alias("second"))


@register(f"""SELECT s_suppkey, '{paths.CLASS_DOCS_URL}' || CASE s_suppkey % 4 WHEN 0 THEN 'java.base/lang/ref/' WHEN 1 THEN 'java.base/lang/' WHEN 2 THEN 'java.base/' ELSE '' END || s_suppkey || '.html' AS uri FROM supplier""")
def class_button_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of class pages as served urls."""
    ups = F.repeat(F.lit("../"), (F.col("s_suppkey") % 4).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", paths.button_uri(F.lit("docs/html/api/java.base/lang/ref/X.html"), F.concat(ups, F.col("s_suppkey").cast("string"), F.lit(".html"))).alias("uri"))


@register("""SELECT n_nationkey, 'm/' || s_suppkey || '.html' AS url, CASE WHEN s_suppkey % 3 = 0 THEN 'Deprecated. <div class="deprecation-comment">' || s_name || '</div>' ELSE '<div class="block">' || s_name || '</div>' END AS description
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def class_index_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Urls and descriptions of class indexes."""
    import pyarrow as pa

    share_code(spark)
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    last = F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit('Deprecated.\n<div class="deprecation-comment">'), name, F.lit("</div>"))).otherwise(F.concat(F.lit('<div class="block">'), name, F.lit("</div>")))
    row = F.concat(F.lit('<div class="col-first x"><a href="m/'), key, F.lit('.html">'), name, F.lit('</a></div><div class="col-last x">'), last, F.lit("</div>"))
    head = '<div id="all-classes-table.tabpanel"><div class="table-header col-first">Class</div><div class="table-header col-last">Text</div>'
    pages = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.concat(F.lit(head), F.array_join(F.collect_list(row), "\n"), F.lit("</div>")).alias("html"))

    def run(batches):
        for batch in batches:
            rows = [(k, *p) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for p in tooltips.class_index(html.parse(t))]
            yield pa.RecordBatch.from_pylist([{"n_nationkey": k, "url": u, "description": d} for k, u, d in rows], pa.schema([("n_nationkey", pa.int32()), ("url", pa.string()), ("description", pa.string())]))

    return pages.select(F.col("s_nationkey").cast("int").alias("s_nationkey"), "html").mapInArrow(run, "n_nationkey int, url string, description string")


@register("""SELECT 'java' AS category, 'pkg.' || s_name AS tag, CASE WHEN s_suppkey % 2 = 0 THEN 'summary ' || s_suppkey ELSE 'No summary available' END AS summary,
  '<div class="block">' || s_name || '</div>' AS detail, 'Learn more about pkg package' AS label FROM supplier""")
def class_tooltips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tooltips of class pages: one parse each, joined to the index."""
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    page = F.concat(F.lit('<meta name="keywords" content="m(x) y"><meta name="keywords" content="pkg.'), name, F.lit(' class"><div class="header"><div class="sub-title"><span class="package-label-in-type">P</span><a href="../s.html">pkg</a></div></div><section class="class-description"><div class="type-signature">no</div><div class="block">'), name, F.lit("</div></section>"))
    suppliers = table(spark, sf_dir, "supplier")
    pages = suppliers.select(F.concat(F.lit("docs/api/m/"), key, F.lit(".html")).alias("path"), F.encode(page, "utf-8").alias("content"))
    index = suppliers.where("s_suppkey % 2 = 0").select(F.concat(F.lit("m/"), key, F.lit(".html")).alias("url"), F.concat(F.lit("summary "), key).alias("description"), F.col("s_suppkey").alias("seq"))
    tips = tooltips.class_tooltips(pages, index, "docs/api")
    first = F.from_json("tooltipButtons", f"array<{tooltips.BUTTON}>")[0]["first"]
    return tips.select(F.col("tooltipCategory").alias("category"), F.col("tooltipTag").alias("tag"), F.col("tooltipSummary").alias("summary"), F.col("tooltipDetail").alias("detail"), first.alias("label"))


# extension ----------------------------------------------------------------------------------------------------------


@register("SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows; the same plan serves streams (an extension)."""
    return ingest.event_counts(table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))
