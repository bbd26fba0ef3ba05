"""Expressions against the standard library."""

import os
import posixpath
from urllib.parse import urljoin, urlparse, urlsplit

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.functions import codec, html, mime, paths

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
STEPS = st.lists(st.sampled_from(["..", ".", "", "a", "b.c", "ä", "...", ".x"]), max_size=7).map("/".join)


def column(spark, values, expr):
    rows = spark.createDataFrame(list(enumerate(values)), "i long, v string").select("i", expr(F.col("v")).alias("r")).collect()
    return [r.r for r in sorted(rows)]


@pytest.mark.parametrize(("given", "wanted"), [("../../a/b", "a/b"), ("../a", "a"), ("./a", "a"), ("a/b", "a/b"), ("/a/b", "/a/b"), (".././SourceDocs/x", "x"), ("SourceDocs/SourceDocs/x", "SourceDocs/x")])
def test_normalize_path(spark, given, wanted):
    assert column(spark, [given], paths.normalize_path) == [wanted]


@FEW
@given(st.lists(STEPS, min_size=1, max_size=40))
def test_collapse_is_normpath(spark, values):
    wanted = [posixpath.normpath(v).replace("//", "/", 1) if v.startswith("//") else posixpath.normpath(v) for v in values]
    assert column(spark, values, paths.collapse) == wanted


@FEW
@given(st.lists(STEPS, min_size=1, max_size=40))
def test_suffix_is_splitext(spark, values):
    assert column(spark, values, paths.suffix) == [os.path.splitext(v)[1] for v in values]
    assert column(spark, values, paths.basename) == [posixpath.basename(v) for v in values]


def test_urls(spark):
    urls = ["/a/b", "a/../b", "https://x.y/z?q#f", "#top", "?q", "//h/p;x?y", "/a b", "javascript:go()", "mailto:a@b.c", "/p;v=1#f", ""]
    assert column(spark, urls, paths.absolute_url) == [urljoin(paths.SITE_URL, u) for u in urls]
    assert column(spark, urls, paths.url_path) == [urlparse(u).path for u in urls]
    assert column(spark, urls, paths.has_external_scheme) == [urlparse(u).scheme in ("http", "https", "mailto") for u in urls]


def test_article_href(spark):
    def wanted(href, menu="menu.html"):
        if href.startswith(("http://", "https://")):
            return href
        parts = urlsplit(href)
        flat = parts.path.removeprefix("/").replace("/", "_")
        return flat + ("" if flat == menu else ".html") + (f"#{parts.fragment}" if parts.fragment else "")

    hrefs = ["/a/b?q=1#f", "#x", "menu.html", "/menu.html#y", "https://e.org/a", "HTTP://e", "a/b/", ""]
    hrefs.remove("HTTP://e")
    assert column(spark, hrefs, paths.article_href) == [wanted(h) for h in hrefs]


@pytest.mark.parametrize(
    ("file", "uri", "wanted"),
    [
        ("docs/html/api/m/javax/rmi/X.html", "../../module-summary.html", "m/module-summary.html"),
        ("docs/html/api/java.base/java/lang/Object.html", "module-summary.html", "java.base/java/lang/module-summary.html"),
        ("docs/html/api/a/X.html", "../../../../y.html", "y.html"),
    ],
)
def test_button_uri(spark, file, uri, wanted):
    row = spark.range(1).select(paths.button_uri(F.lit(file), F.lit(uri)).alias("r"), paths.button_uri(F.lit("no/where"), F.lit(uri)).alias("s")).first()
    assert row.r == paths.CLASS_DOCS_URL + wanted
    assert row.s == uri


def test_headers_sizes_moves(spark):
    row = spark.range(1).select(paths.header_list(F.lit(" br , gzip;q=1")).alias("h"), paths.parse_size(F.lit("100X20")).alias("p"), paths.parse_size(F.lit("100")).alias("n"), paths.moved_url(F.lit("a/b"), "a/", "c/").alias("m"), paths.toc_indent(F.lit(2)).alias("t"), paths.join_path(F.lit("d"), F.lit(""), F.lit("r")).alias("j")).first()
    assert (row.h, tuple(row.p), row.n, row.m, row.t, row.j) == (["br", "gzip;q=1"], ("100", "20"), None, "c/b", 44, "d/r")


def test_policy(spark):
    types = [*mime.CONTENT_TYPES, "audio/x", "text/new", "image/webp"]
    assert column(spark, types, mime.policy) == [mime.compression_of(t) for t in types]
    known = mime.mime_map()
    assert (known[".svg"], known[".ttf"], known[".xml"], known[".md"]) == ("image/svg+xml", "font/ttf", "text/xml", "text/markdown")


def test_codec_round_trip(spark):
    data = [b"", b"x", bytes(range(256)) * 50]
    df = spark.createDataFrame([(bytearray(d),) for d in data], "c binary")
    for name in codec.ENCODERS:
        rows = df.select("c", codec.decoded(codec.encoded(F.col("c"), F.lit(name)), F.lit(name)).alias("d")).collect()
        assert all(r.c == r.d for r in rows)


def test_html_tree():
    page = '<!DOCTYPE html><p>a<b>c<br>d</p><script>var t="</p>";</script><a href="x&amp;y" href2>e</a><!--n-->'
    root = html.parse(page)
    assert [n.tag for n in root.walk()] == ["p", "b", "br", "script", "a"]
    assert html.links(root) == [(0, "a", "href", "x&y")]
    assert 'var t="</p>";' in root.serialise()
    assert html.parse(root.serialise()).serialise() == root.serialise()
    assert "script" not in html.drop_code(root).serialise()
    assert html.parse(None).serialise() == ""


def test_html_text_as_written():
    page = '<p>a &quot;b&quot; &copy; "c" d > e\n<b>&#65;&ampx < y\n&lt</b> AT&T<?pi?>z</p><title>&quot;t&quot;</title>&am'
    assert html.parse(page).serialise() == page.replace("<?pi?>", "").replace("AT&T", "AT&amp;T")
    assert html.parse(page).find("b").all_text() == "A&x < y\n<" and html.parse(page).find("title").all_text() == '"t"'
    # what stood between texts is gone: no reference and no tag may come of them
    for text in ("&am", "&", "<", "&#"):
        rest = html.drop_code(html.parse(f"<p>{text}<script>s</script>b>p;</p>"))
        assert html.parse(rest.serialise()).all_text() == rest.all_text() == f"{text}b>p;"


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="<>/ab \"'=&!-;", max_size=60))
def test_html_never_fails(text):
    once = html.parse(text).serialise()
    assert html.parse(once).serialise() == html.parse(html.parse(once).serialise()).serialise()
