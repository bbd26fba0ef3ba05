"""The command line end to end on small folders."""

import json

import pytest

from corpusmill.__main__ import main
from corpusmill.operators import store


def lines(folder):
    return [x for p in sorted(folder.glob("part-*")) for x in p.read_text().splitlines()]


def test_store_commands(spark, tmp_path, capsys):
    docs, home = tmp_path / "docs", f"{tmp_path}/store"
    docs.mkdir()
    (docs / "a.html").write_text("<p>x</p>" * 100)
    (docs / "b.log").write_text("no")
    (docs / "empty.txt").write_text("")
    main(["create", "--store", home], spark)
    main(["ingest", "--directory", str(docs), "--store", home], spark)
    main(["ingest", "--file", f"{docs}/a.html", "--store", home], spark)
    assert store.read(spark, home, "Content").count() == 2
    capsys.readouterr()
    main(["list", "--store", home], spark)
    assert [x.split("\t")[0].rsplit("/", 1)[-1] for x in capsys.readouterr().out.splitlines()] == ["a.html", "empty.txt"]
    main(["stats", "--store", home], spark)
    assert "text/html" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["ingest", "--store", home], spark)
    with pytest.raises(SystemExit):
        main(["import-tooltips", "--sheet", f"{tmp_path}/none.xlsx", "--store", home], spark)


def test_site_commands(spark, tmp_path):
    site = "https://developer.android.com/"
    raw, out = tmp_path / "raw", tmp_path / "out"
    raw.mkdir()
    (raw / "r1").write_text('<article><img src="/img/p"><a href="/b">b</a><a href="https://e.org">e</a></article>')
    (raw / "r2").write_text("<article>two</article>")
    (tmp_path / "docs" / "img").mkdir(parents=True)
    (tmp_path / "docs" / "img" / "r3").write_bytes(b"png")
    (tmp_path / "map.tsv").write_text(f"{site}a\tr1\n{site}b\tr2\n{site}img/p\tr3\n")
    u, r = f"{tmp_path}/u", f"{tmp_path}/r"
    main(["url-maps", "--input", f"{tmp_path}/map.tsv", "--docs-path", f"{tmp_path}/docs", "--url-map", u, "--rid-map", r], spark)
    main(["site", "--input", str(raw), "--output", str(out), "--docs-path", f"{tmp_path}/docs", "--url-map", u, "--rid-map", r, "--menu", "menu.html", "--media", "media", "--size", "10x10"], spark)
    page = (out / "a.html").read_text()
    assert 'src="media/img_p"' in page and 'href="b.html"' in page and 'linkstatus="existing"' in page
    assert (out / "media" / "img_p").read_bytes() == b"png" and (out / "style.css").exists() and (out / "b.html").exists()
    main(["extract-links", "--input", f"{raw}/r1", "--output", f"{tmp_path}/l"], spark)
    assert lines(tmp_path / "l") == ["/b", "https://e.org"]
    main(["targets", "--links", f"{tmp_path}/l", "--url-map", u, "--output", f"{tmp_path}/t"], spark)
    assert lines(tmp_path / "t" / "valid") == [f"{site}b"] and lines(tmp_path / "t" / "invalid") == ["https://e.org"]
    main(["audit-links", "--directory", str(out), "--output", f"{tmp_path}/audit"], spark)
    assert "a.html\tb.html\tvalid" in lines(tmp_path / "audit") and "a.html\tmenu.html\tbroken" in lines(tmp_path / "audit")
    main(["menu", "--input", f"{raw}/r1", "--output", f"{tmp_path}/m"], spark)
    assert (tmp_path / "m" / "r1").read_text() == '<article><img><a href="b.html">b</a><a href="https://e.org">e</a></article>'
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "x.HTML").write_text("<title>t</title><article>x</article>")
    main(["articles", "--input", f"{tmp_path}/k", "--output", f"{tmp_path}/ko", "--menu", "m.html", "--stylesheet", "s.css"], spark)
    assert "<title>t</title>" in (tmp_path / "ko" / "x.HTML").read_text() and (tmp_path / "ko" / "s.css").exists()
    (tmp_path / "t.json").write_text(json.dumps({"entities": {"a": {"id": "a", "title": "A & B", "url": "a.html", "level": 0}}, "topLevelIds": ["a"]}))
    main(["toc", "--json", f"{tmp_path}/t.json", "--output", f"{tmp_path}/toc"], spark)
    assert "A &amp; B" in (tmp_path / "toc" / "toc.html").read_text() and (tmp_path / "toc" / "toc.js").exists()
