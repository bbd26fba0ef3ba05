"""Serving: batched lookups by path and language, with content negotiation and HTTP outcomes."""

from __future__ import annotations

from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import codec, paths
from corpusmill.operators import store
from corpusmill.operators.store import DEFAULT_LANGUAGE
from corpusmill.session import share_code


def language_of(accept_language: Column) -> Column:
    """The first language that a request accepts."""
    return paths.header_list(accept_language, DEFAULT_LANGUAGE)[0]


def accepts_encoding(accept_encoding: Column, token: str = "br") -> Column:
    """Whether the exact token is among the accepted encodings."""
    return F.array_contains(paths.header_list(accept_encoding), token)


def status_of(matches: Column) -> Column:
    """200 for one match, 404 for none, 500 for several."""
    return F.when(matches == 1, 200).when(matches == 0, 404).otherwise(500)


def error_page(status: Column, path: Column, language: Column) -> Column:
    """A short page that says what was asked for and what came of it."""
    phrase = F.when(status == 404, "Not Found").otherwise("Internal Server Error")
    safe = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    said = F.concat(status.cast("string"), F.lit(" "), phrase)
    return F.concat(F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><title>'), said, F.lit("</title></head><body><h1>"), said, F.lit("</h1><dl><dt>path</dt><dd>"), safe(path), F.lit("</dd><dt>language</dt><dd>"), safe(language), F.lit("</dd></dl></body></html>"))


def resolve(requests: DataFrame, content: DataFrame, languages: DataFrame, types: DataFrame) -> DataFrame:
    """Requests (request_id, url, accept_language, accept_encoding) with path, language, status, and of the single match
    content, content_type and compression. One row per request. Only what is asked for is looked up, by path and language
    without content; content is joined last, by id, for single matches."""
    asked = requests.select("request_id", F.col("url").substr(F.lit(2), F.length("url")).alias("path"), language_of(F.col("accept_language")).alias("language"), "accept_encoding")
    wanted = asked.select("path", "language").distinct()
    named = languages.select(F.col("id").alias("languageID"), F.col("value").alias("language"))
    typed = types.select(F.col("id").alias("contentTypeID"), F.col("value").alias("content_type"))
    narrow = content.select("id", "path", "languageID", "contentTypeID").join(wanted.select("path").distinct(), "path", "left_semi")
    known = narrow.join(F.broadcast(named), "languageID").join(F.broadcast(typed), "contentTypeID").join(wanted, ["path", "language"], "left_semi")
    found = known.groupBy("path", "language").agg(F.count("*").alias("matches"), F.min("id").alias("id"), F.min_by("content_type", "id").alias("content_type"))
    bodies = content.join(found.where("matches = 1").select("id"), "id", "left_semi").select("id", "content", "compression")
    found = found.join(bodies, "id", "left").select("path", "language", "matches", F.struct("content", "content_type", "compression").alias("hit"))
    joined = asked.join(found, ["path", "language"], "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return joined.withColumn("status", status_of(F.col("matches"))).select("request_id", "path", "language", "accept_encoding", "status", F.when(F.col("status") == 200, F.col("hit")).alias("hit"))


def respond(resolved: DataFrame) -> DataFrame:
    """(request_id, status, content_type, content_encoding, content_length, body). What the client does not accept as stored
    is decoded; errors are pages."""
    share_code(resolved.sparkSession)
    kind = F.col("hit.compression")
    token = F.when(kind == "brotli", "br").when(kind == "deflate", "deflate")
    kept = F.array_contains(paths.header_list(F.col("accept_encoding")), token) & token.isNotNull()
    body = F.when(F.col("status") != 200, F.encode(error_page(F.col("status"), F.col("path"), F.col("language")), "utf-8")).when(F.coalesce(kept, F.lit(False)), F.col("hit.content")).otherwise(codec.decoded(F.col("hit.content"), F.coalesce(kind, F.lit("none"))))
    out = resolved.withColumns({"body": body, "content_encoding": F.when((F.col("status") == 200) & kept, token)})
    return out.select("request_id", "status", F.coalesce("hit.content_type", F.lit("text/html")).alias("content_type"), "content_encoding", F.octet_length("body").cast("long").alias("content_length"), "body")


def answer(spark: SparkSession, home: str, url: str, accept_language: str | None = None, accept_encoding: str | None = None) -> dict[str, object]:
    """The response to one request to the store in ``home``."""
    asked = spark.createDataFrame([(0, url, accept_language, accept_encoding)], "request_id long, url string, accept_language string, accept_encoding string")
    return respond(resolve(asked, *(store.read(spark, home, name) for name in store.TABLES))).first().asDict()


def server(spark: SparkSession, home: str, host: str = "127.0.0.1", port: int = 0) -> ThreadingHTTPServer:
    """An HTTP server over a store, for a reader at a desk; each request is a lookup of its own (port 0: any free one)."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            found = answer(spark, home, self.path, self.headers.get("Accept-Language"), self.headers.get("Accept-Encoding"))
            self.send_response(found["status"])
            self.send_header("Content-Type", found["content_type"])
            self.send_header("Content-Length", str(found["content_length"]))
            if found["content_encoding"]:
                self.send_header("Content-Encoding", found["content_encoding"])
            self.end_headers()
            self.wfile.write(bytes(found["body"]))

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
