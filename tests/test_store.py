"""The store, serving, tooltips, sources and sinks end to end."""

import os
import random
import sqlite3
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from corpusmill.functions import codec
from corpusmill.operators import analysis, documents, links, serve, store, toc, tooltips
from corpusmill.sources import files, sheets, sinks, tables
from corpusmill.streaming import ingest


def png(width=2):
    def chunk(kind, data):
        return len(data).to_bytes(4, "big") + kind + data + zlib.crc32(kind + data).to_bytes(4, "big")

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", width.to_bytes(4, "big") + (1).to_bytes(4, "big") + b"\x08\x02\0\0\0") + chunk(b"IDAT", zlib.compress(b"\0" * (1 + 3 * width))) + chunk(b"IEND", b"")


PROSE = ("lorem ipsum dolor " * 400).encode()
FILES = {
    "a.html": PROSE,
    "a.txt": PROSE,
    "a.css": PROSE,
    "a.md": PROSE,
    "a.jpg": b"\xff\xd8\xff" + PROSE,
    "a.gif": b"GIF89a" + PROSE,
    "a.png": png(),
    "a.svg": b"<svg>" + PROSE,
    "a.ttf": b"\0\1ttf",
    "x.version": PROSE,
    "bad.png": b"\xff\xd8\xff" + PROSE,
    "x.xml": PROSE,
    "x.rdf": PROSE,
    "x.HTML": PROSE,
    "nothing": PROSE,
}


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    for name, data in FILES.items():
        (d / name).write_bytes(data)
    return str(d)


def test_ingest(spark, folder, tmp_path):
    home = f"{tmp_path}/store"
    rows = files.binary(spark, folder).select(F.concat(F.lit("../SourceDocs/"), F.regexp_extract("path", "[^/]*$", 0)).alias("path"), "content")
    report = {r.path: r.reject_reason for r in store.ingest(spark, rows, home).collect()}
    assert {p: r for p, r in report.items() if r} == {"x.version": "unknown_extension", "bad.png": "invalid_image", "x.xml": "unknown_type", "x.rdf": "xml", "x.HTML": "unknown_extension", "nothing": "unknown_extension"}
    content, languages = store.read(spark, home, "Content"), store.read(spark, home, "Languages")
    stored = {r.path: r for r in content.collect()}
    assert sorted(r.id for r in stored.values()) == list(range(1, 10))
    for name, row in stored.items():
        same = name.endswith((".jpg", ".gif", ".png", ".ttf"))
        assert (len(row.content) == len(FILES[name])) == same
        assert store.get_file(content, languages, name) == FILES[name]
    with pytest.raises(FileNotFoundError):
        store.get_file(content, languages, "a.html", "de")
    assert {r.reject_reason for r in store.ingest(spark, rows, home).where("path = 'a.html'").collect()} == {"duplicate"}
    content = store.read(spark, home, "Content")
    assert content.count() == 9
    totals = store.stats(content).first()
    assert totals.files == 9 and totals.stored_bytes == sum(len(r.content) for r in content.collect()) < totals.input_bytes
    assert {r.content_type: r.files for r in store.summary(content, store.read(spark, home, "ContentTypes")).collect()}["text/html"] == 1
    asked = spark.createDataFrame([(1, "/a.html", None, "gzip"), (2, "/a.html", "en-US,de", codec.TOKENS[codec.COMPRESSED]), (3, "/nope", None, None), (4, "/a.svg", None, "")], "request_id long, url string, accept_language string, accept_encoding string")
    got = {r.request_id: r for r in serve.respond(serve.resolve(asked, content, languages, store.read(spark, home, "ContentTypes"))).collect()}
    assert got[1].status == 200 and bytes(got[1].body) == PROSE and got[1].content_encoding is None and got[1].content_length == len(PROSE)
    assert got[2].content_encoding == codec.TOKENS[codec.COMPRESSED] and zlib.decompress(bytes(got[2].body)) == PROSE
    assert got[3].status == 404 and b"Not Found" in bytes(got[3].body)
    assert bytes(got[4].body) == FILES["a.svg"]


def test_rejected_files_take_no_path(spark, tmp_path):
    home, good = f"{tmp_path}/s", png()
    rows = spark.createDataFrame([("../a.png", b"no picture"), ("./a.png", good), ("a.png", png(3)), ("../b.txt", b"one"), ("../b.txt", b"one"), ("b.txt", b"two"), ("c.png", good + b"trailing bytes"), ("d.png", good[:-4])], "path string, content binary")
    report = sorted((r.source, r.reject_reason or "") for r in store.ingest(spark, rows, home, png=lambda data: data + b"!").collect())
    assert report == sorted([("../a.png", "invalid_image"), ("./a.png", ""), ("a.png", "duplicate"), ("../b.txt", ""), ("../b.txt", "duplicate"), ("b.txt", "duplicate"), ("c.png", ""), ("d.png", "invalid_image")])
    content, languages = store.read(spark, home, "Content"), store.read(spark, home, "Languages")
    assert content.count() == 3 and store.get_file(content, languages, "a.png") == good + b"!" and store.get_file(content, languages, "b.txt") == b"one"
    assert {r.path: r.input_bytes for r in content.collect()}["a.png"] == len(good)


def test_server(spark, tmp_path):
    import threading
    import urllib.error
    import urllib.request

    home = f"{tmp_path}/s"
    store.ingest(spark, spark.createDataFrame([("d/a.html", PROSE)], "path string, content binary"), home)
    with serve.server(spark, home) as running:
        threading.Thread(target=running.serve_forever, daemon=True).start()
        base = "http://{}:{}".format(*running.server_address)
        with urllib.request.urlopen(f"{base}/d/a.html", timeout=60) as got:
            assert got.read() == PROSE and got.headers["Content-Type"] == "text/html"
        with pytest.raises(urllib.error.HTTPError, match="404"):
            urllib.request.urlopen(f"{base}/<none>", timeout=60)
        running.shutdown()


def test_lookups_read_content_of_what_is_asked_for(spark, tmp_path):
    home = f"{tmp_path}/s"
    store.ingest(spark, spark.createDataFrame([(f"f{i}.txt", b"x") for i in range(50)], "path string, content binary"), home)
    asked = spark.createDataFrame([(i, "/f7.txt", None, None) for i in range(3)] + [(9, "/f8.txt", "de", None)], "request_id long, url string, accept_language string, accept_encoding string")
    found = serve.resolve(asked, *(store.read(spark, home, t) for t in store.TABLES))
    assert sorted((r.request_id, r.status) for r in found.collect()) == [(0, 200), (1, 200), (2, 200), (9, 404)]


def test_staged_corpus(spark, tmp_path):
    (tmp_path / "docs_version.txt").write_text("abc123\n")
    (tmp_path / "a.html").write_text("<p>")
    assert [(r.path.rsplit("/", 1)[-1], r.docs_version) for r in files.staged(spark, str(tmp_path)).collect()] == [("a.html", "abc123")]


def test_empty_and_wrong_stores(spark, tmp_path):
    home = f"{tmp_path}/store"
    store.create(spark, home)
    store.create(spark, home)
    assert store.stats(store.read(spark, home, "Content")).first()[:3] == (0, 0, 0)
    assert [r.value for r in store.read(spark, home, "Languages").collect()] == ["en-US"]
    os.mkdir(f"{home}/Strange")
    with pytest.raises(ValueError, match="Strange"):
        store.create(spark, home)


def test_many_small_files(spark, tmp_path):
    rows = spark.range(1000).select(F.concat(F.lit("f"), F.col("id").cast("string"), F.lit(".txt")).alias("path"), F.encode(F.repeat(F.lit("Hello, world!\n"), 10), "utf-8").alias("content"))
    store.ingest(spark, rows, f"{tmp_path}/s")
    got = store.stats(store.read(spark, f"{tmp_path}/s", "Content")).first()
    assert (got.files, got.input_bytes) == (1000, 140_000) and got.percent_saved > 50


def sheet(path, rows, header=sheets.HEADER):
    cell = lambda c, v: "" if v is None else f'<c r="{c}" t="b"><v>{int(v)}</v></c>' if isinstance(v, bool) else f'<c r="{c}"><v>{v}</v></c>' if isinstance(v, int) else f'<c r="{c}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = "".join(f'<row r="{i}">' + "".join(cell(f"{chr(65 + j)}{i}", v) for j, v in enumerate(row)) + "</row>" for i, row in enumerate([header, *rows], 1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="s" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')


def test_tooltip_sheet(spark, tmp_path):
    path, home = f"{tmp_path}/t.xlsx", f"{tmp_path}/store"
    full = ["t", "c", "s", "d", "b1", "https://kotlinlang.org/docs/x", "b2", "u2", None, None]
    rows = [full, [None, *full[1:]], ["FALSE", *full[1:]], [True, *full[1:]], ["t", "c", "new", None, "b1", "u1", *[None] * 4], [0, *full[1:]]]
    sheet(path, rows)
    done = tooltips.import_sheet(spark, path, home)
    assert (done["total_rows"], done["processed_rows"]) == (6, 4)
    assert [r for r, _ in done["skipped_rows"]] == [3, 7] and "tag" in done["skipped_rows"][0][1]
    got = {r.tooltipTag: r for r in store.read(spark, home, store.TOOLTIPS).collect()}
    assert set(got) == {"t", "FALSE", "True"}
    assert (got["t"].tooltipSummary, got["t"].tooltipDetail) == ("new", " ")
    assert got["FALSE"].tooltipButtons == '[{"first":"b1","second":"http://localhost:6174/KotlinDocs/html/x"},{"first":"b2","second":"u2"}]'
    tooltips.import_sheet(spark, path, home)
    assert store.read(spark, home, store.TOOLTIPS).count() == 3
    sheet(path, rows, header=("wrong", *sheets.HEADER[1:]))
    with pytest.raises(ValueError, match="header"):
        tooltips.import_sheet(spark, path, home)
    (tmp_path / "c.xlsx").write_bytes(b"no zip")
    with pytest.raises(zipfile.BadZipFile):
        tooltips.import_sheet(spark, f"{tmp_path}/c.xlsx", home)


INDEX = """<div id="all-classes-table.tabpanel"><div class="table-header col-first">Class</div><div class="table-header col-last">Text</div>
<div class="col-first even"><a href="m/p/About.html">About</a></div><div class="col-last even"><div class="block">Event
sent.</div></div><div class="col-first odd"><a href="m/p/Sockets.html">Sockets</a></div><div class="col-last odd">
Deprecated.
<div class="deprecation-comment">Use others.</div></div></div>"""
PAGE = """<html><head><meta name="keywords" content="m.p.{0} class"><meta name="keywords" content="run()"></head><body><div class="header">
<div class="sub-title"><span class="module-label-in-type">Module</span><a href="../module-summary.html">m</a></div>
<div class="sub-title"><span class="package-label-in-type">Package</span><a href="package-summary.html">m.p</a></div></div>
<section class="class-description"><hr><div class="type-signature">public</div><div class="block">Says {0}<p>twice.</div></section></body></html>"""


def test_class_docs(spark, tmp_path):
    root = tmp_path / "html" / "api"
    for name in ("About", "Sockets", "Plain"):
        (root / "m" / "p" / "class-use").mkdir(parents=True, exist_ok=True)
        (root / "m" / "p" / f"{name}.html").write_text(PAGE.format(name))
        (root / "m" / "p" / "class-use" / f"{name}.html").write_text("use")
    for name in ("package-summary.html", "index.html", "coll-x.html", "index-3.html"):
        (root / "m" / "p" / name).write_text("none")
    (root / "allclasses-index.html").write_text(INDEX)
    assert tooltips.import_class_docs(spark, str(root), f"{tmp_path}/store") == 3
    got = {r.tooltipTag: r for r in store.read(spark, f"{tmp_path}/store", store.TOOLTIPS).collect()}
    assert got["m.p.About"].tooltipSummary == '<div class="block">Event sent.</div>'
    assert got["m.p.Sockets"].tooltipSummary == 'Deprecated. <div class="deprecation-comment">Use others.</div>'
    assert got["m.p.Plain"].tooltipSummary == tooltips.NO_SUMMARY
    assert "public" not in got["m.p.Plain"].tooltipDetail and "Says Plain" in got["m.p.Plain"].tooltipDetail
    assert '"second":"http://localhost:6174/JavaDocs/html/api/m/module-summary.html"' in got["m.p.Plain"].tooltipButtons


def test_link_audit(spark, tmp_path):
    (tmp_path / "first.html").write_text('<a href="second.html">1</a><a href="second.html#f">2</a><a href="none.html">3</a><a href="https://e.org">4</a><a href="mailto:x@e.org">5</a><a href="">6</a>')
    (tmp_path / "second.html").write_text('<script src="s.js"></script><img src="sub"><a href="#here">x</a><a HREF=first.html>y</a>')
    (tmp_path / "s.js").write_text("")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.txt").write_text("x")
    pages = files.html_files(spark, str(tmp_path)).select(F.col("path").alias("file"), F.decode("content", "utf-8").alias("html"))
    found = links.extract(pages, "file", tags=None, attrs=("href", "src"))
    there = links.folders(files.inventory(spark, str(tmp_path)).select(F.col("file_name").alias("path")))
    there = there.select(F.concat(F.lit("/"), "path").alias("path")) if not there.first().path.startswith("/") else there
    audit = links.audit(found, there)
    sinks.write_tsv(audit.select("file", "url", "status"), f"{tmp_path}/report", header=False)
    got = sorted((r.file.rsplit("/", 1)[-1], r.url, r.status) for r in audit.collect())
    assert got == sorted([("first.html", "second.html", "valid"), ("first.html", "second.html#f", "valid"), ("first.html", "none.html", "broken"), ("first.html", "https://e.org", "external"), ("first.html", "mailto:x@e.org", "external"), ("second.html", "s.js", "valid"), ("second.html", "sub", "valid"), ("second.html", "#here", "valid"), ("second.html", "first.html", "valid")])


def test_article(spark):
    page = '<html><head><title>T</title><style>x</style></head><body><div class="navigation-links b">n</div><article><a href="https://e.org">o</a><a href="i.html" style="x;">i</a><div class="code-block">c</div><script>s</script></article></body></html>'
    df = spark.createDataFrame([("p/a.html", page), ("p/b.html", "<p>none")], "path string, html string")
    got = {r.path: r for r in documents.debloat_articles(df).collect()}
    assert got["p/b.html"].status == "raw" and got["p/b.html"].clean == "<p>none"
    clean = got["p/a.html"].clean
    assert "<title>T</title>" in clean and "script" not in clean and ">n<" not in clean
    assert 'style="color: red !important;"' in clean and 'style="x;color: blue !important;"' in clean and "font-family: monospace" in clean


def test_site(spark):
    page = '<article><div id="devsite-article-meta">m</div><devsite-x>w</devsite-x><img src="/i.png"><img src="/gone.png"><a href="/b/c?q#f" class="k">1</a><a href="/z">2</a><a href="https://e.org">3</a><a href="/q?a=1&amp;b=2">4</a><a href="/it&apos;s here">5</a></article>'
    df = spark.createDataFrame([("x/a", page), ("x/b_c", "<article>t</article>"), ("x/it's here", "none"), ("x/n", "no")], "path string, html string")
    media = spark.createDataFrame([("x/a", "/i.png", "media/i.png")], "path string, src string, new_src string")
    got = {r.path: r for r in documents.debloat_site(df, media, "menu.html").collect()}
    clean = got["x/a"].clean
    assert got["x/a"].output_name == "a.html" and got["x/n"].clean is None
    assert 'src="media/i.png"' in clean and "gone" not in clean and clean.count("<svg") == 1 and "devsite" not in clean
    assert '<a href="b_c.html#f" class="k existing" linkstatus="existing">' in clean and clean.count('linkstatus="existing"') == 2 and clean.count('linkstatus="non-existing"') == 2 and 'class="external"' in clean


def test_toc(spark, tmp_path):
    rng = random.Random(1)
    pages, order = {}, []

    def add(parent, level):
        key = f"e{len(pages)}"
        pages[key] = {"id": key, "title": f"T{key}", "level": level, "tabIndex": rng.randrange(3)} | ({"parentId": parent} if parent else {}) | ({"url": f"{key}.html"} if rng.random() < 0.7 else {"pages": []})
        if level < 4:
            for _ in range(rng.randrange(4)):
                add(key, level + 1)

    roots = []
    for _ in range(6):
        roots.append(f"e{len(pages)}")
        add(None, 0)
    pages["lost"] = {"id": "lost", "title": "l", "level": 1, "parentId": "nowhere"}
    pages["c1"], pages["c2"] = {"id": "c1", "title": "", "level": 1, "parentId": "c2"}, {"id": "c2", "title": "", "level": 1, "parentId": "c1"}

    def walk(key):
        order.append(key)
        for child in sorted((k for k, p in pages.items() if p.get("parentId") == key), key=lambda k: pages[k].get("tabIndex", 0)):
            walk(child)

    for r in roots:
        walk(r)
    import json

    (tmp_path / "toc.json").write_text(json.dumps({"entities": {"pages": pages}, "topLevelIds": [*roots, "unknown"]}))
    entries, top = tables.toc(spark, f"{tmp_path}/toc.json")
    flat = toc.flatten(entries, top)
    assert [r.id for r in toc.positions(flat).orderBy("position").collect()] == order
    assert {r.id for r in toc.unreachable(entries, flat).collect()} == {"lost", "c1", "c2"}
    page = toc.document(toc.items(flat))
    assert page.count("<li ") == len(order) and page.index(f'data-id="{order[0]}"') < page.index(f'data-id="{order[-1]}"')


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "map.tsv").write_text("https://developer.android.com/a/b\tr1\n\nhttps://developer.android.com/c\tr2\nhttps://developer.android.com/a/b\tr3\n")
    urls, rids = links.url_maps(tables.url_pairs(spark, f"{tmp_path}/map.tsv"), "docs")
    assert {r.url[-3:]: r.file for r in urls.collect()} == {"a/b": "docs/a/r3", "m/c": "docs/r2"}
    assert {r.rid: r.file_key for r in rids.collect()} == {"r1": "a_b", "r2": "c", "r3": "a_b"}
    (tmp_path / "bad.tsv").write_text("only one\n")
    with pytest.raises(Exception, match="not two fields"):
        tables.url_pairs(spark, f"{tmp_path}/bad.tsv").collect()
    (tmp_path / "lines.txt").write_text(" a \n\n b\n")
    assert [r.line for r in files.lines(spark, f"{tmp_path}/lines.txt").collect()] == ["a", "b"]
    assert files.whole_text(spark, f"{tmp_path}/lines.txt").first().text.startswith("a")
    with sqlite3.connect(f"{tmp_path}/x.db") as db:
        db.execute("CREATE TABLE t (a INTEGER, b TEXT)")
        db.executemany("INSERT INTO t VALUES (?, ?)", [(i, f"v{i}") for i in range(100)])
    assert tables.sqlite(spark, f"{tmp_path}/x.db", "t", "a long, b string").agg(F.sum("a")).first()[0] == 4950
    with zipfile.ZipFile(f"{tmp_path}/z.zip", "w") as z:
        z.writestr("d/f.txt", "data")
    assert [(r.path, bytes(r.content)) for r in files.unzip(spark, f"{tmp_path}/z.zip").collect()] == [("d/f.txt", b"data")]
    (tmp_path / "index.js").write_text('typeSearchIndex = [{"p":"java.lang","l":"Object"},{"l":"All"}];updateSearchResults();')
    assert [r.l for r in tables.search_index(spark, f"{tmp_path}/index.js").collect()] == ["Object", "All"]
    out = f"{tmp_path}/out"
    assert sinks.write_files(sinks.assets(spark), out).count() == 4 and os.path.getsize(f"{out}/toc.js") > 0
    with pytest.raises(Exception, match="outside the folder"):
        sinks.write_files(spark.createDataFrame([("../x", "y")], "path string, content string"), out).collect()
    plan = spark.createDataFrame([(f"{out}/toc.js", f"{tmp_path}/copy/t.js"), (f"{out}/no", f"{tmp_path}/copy/n")], "src string, dst string")
    assert {r.dst[-4:]: r.copied for r in sinks.copy_files(plan).collect()} == {"t.js": True, "py/n": False}
    sinks.write_lines(spark.createDataFrame([("a",), (None,)], "x string"), "x", f"{tmp_path}/w")
    assert [r.value for r in spark.read.text(f"{tmp_path}/w").collect()] == ["a"]
    assert [r.line for r in sinks.run_parameters(spark, {"k": 1}).collect()] == ["k: 1"]
    inv = files.inventory(spark, out)
    assert {r.file_extension for r in analysis.by_extension(inv).collect()} == {"css", "js"}
    assert files.synthetic(spark, 20, 3).collect() == files.synthetic(spark, 20, 3).collect()


def test_streaming_ingest(spark, folder, tmp_path):
    home = f"{tmp_path}/store"
    for _ in range(2):
        ingest.watch(spark, folder, home, f"{tmp_path}/cp").awaitTermination()
        assert store.read(spark, home, "Content").count() == 9
