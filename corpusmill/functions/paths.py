"""Path and URL functions as Catalyst expressions; Arrow-batched functions only where RFC 3986 resolution asks for it."""

from __future__ import annotations

import posixpath
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default roots of the store and of the served class documentation.
STORE_ROOT = "SourceDocs/"
CLASS_DOCS_URL = "http://localhost:6174/JavaDocs/html/api/"
SITE_URL = "https://developer.android.com/"
TOC_ICON_WIDTH = 16


def normalize_path(path: Column, root: str = STORE_ROOT) -> Column:
    """Leading ``../`` and ``./`` steps go, then one leading ``root``; absolute paths stay."""
    return F.regexp_replace(F.regexp_replace(path, r"^([.][.]/|[.]/)+", ""), f"^{root.replace('.', '[.]')}", "")


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/]*$", 0)


def dirname(path: Column) -> Column:
    """All before the last slash; empty where there is none."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def suffix(path: Column) -> Column:
    """The extension with its dot; names that only begin with dots have none (empty)."""
    return F.regexp_extract(basename(path), r"^[.]*[^.].*([.][^.]*)$", 1)


def extension(path: Column) -> Column:
    """What follows the last dot of the file name, null if it has no dot."""
    name = basename(path)
    return F.when(name.contains("."), F.regexp_extract(name, r"[^.]*$", 0))


def relative_to(path: Column, root: str) -> Column:
    """``path`` below ``root``."""
    prefix = root.rstrip("/") + "/"
    return F.when(path.startswith(prefix), path.substr(F.lit(len(prefix) + 1), F.length(path))).otherwise(path)


def without_root(path: Column, root: str) -> Column:
    """``path`` with every occurrence of ``root`` taken out."""
    return F.replace(path, F.lit(root), F.lit(""))


def url_directory(url: Column, site: str = SITE_URL) -> Column:
    """The url's directory below the site."""
    return dirname(F.replace(url, F.lit(site), F.lit("")))


def url_key(url: Column, site: str = SITE_URL) -> Column:
    """A flat file name for a url of the site."""
    return F.translate(F.replace(url, F.lit(site), F.lit("")), "/", "_")


def join_path(*parts: Column) -> Column:
    """Parts joined by slashes; empty ones are left out."""
    return F.concat_ws("/", *(F.nullif(p, F.lit("")) for p in parts))


def is_absolute(url: Column) -> Column:
    """Begins with http:// or https://, in lower case as written."""
    return url.startswith("http://") | url.startswith("https://")


def has_external_scheme(url: Column) -> Column:
    """Scheme http, https or mailto in any letter case."""
    return F.lower(url).rlike("^(https?|mailto):")


def menu_href(href: Column) -> Column:
    """A menu link as a flat file name: absolute urls stay; query and fragment stay before the suffix."""
    return F.when(is_absolute(href), href).otherwise(F.concat(F.translate(F.regexp_replace(href, "^/", ""), "/", "_"), F.lit(".html")))


def article_href(href: Column, menu_file: str = "menu.html") -> Column:
    """An article's local link: the query goes, the fragment follows the suffix, the menu's own name gets none."""
    path = F.regexp_replace(F.regexp_replace(href, r"(?s)[#?].*$", ""), r"^//[^/]*", "")
    flat = F.translate(F.regexp_replace(path, "^/", ""), "/", "_")
    fragment = F.regexp_extract(href, r"(?s)#(.*)$", 1)
    name = F.when(flat == menu_file, flat).otherwise(F.concat(flat, F.lit(".html")))
    return F.when(is_absolute(href), href).otherwise(F.concat(name, F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise("")))


def button_uri(file_path: Column, uri: Column, base: str = CLASS_DOCS_URL) -> Column:
    """A link of a class page as a url of the served documentation: each ``../`` takes one directory off the page's own."""
    at = F.instr(file_path, "/api/")
    folders = F.split(dirname(file_path.substr(at + 5, F.length(file_path))), "/")
    ups = F.size(F.split(uri, r"[.][.]/")) - 1
    kept = F.array_join(F.slice(folders, F.lit(1), F.greatest(F.size(folders) - ups, F.lit(0))), "/")
    prefix = F.when(kept == "", F.lit("")).otherwise(F.concat(kept, F.lit("/")))
    return F.when(at == 0, uri).otherwise(F.concat(F.lit(base), prefix, F.replace(uri, F.lit("../"), F.lit(""))))


def moved_url(uri: Column, old: str, new: str) -> Column:
    """``uri`` with the prefix ``old`` replaced by ``new``."""
    return F.when(uri.startswith(old), F.replace(uri, F.lit(old), F.lit(new))).otherwise(uri)


def url_path(url: Column) -> Column:
    """The path of a url: scheme, host, parameters, query and fragment go; it never fails, whatever the text."""
    plain = F.regexp_replace(F.regexp_replace(url, r"(?s)[#?].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*:", "")
    return F.regexp_replace(F.regexp_replace(plain, r"^//[^/]*", ""), r";[^/]*$", "")


def collapse(path: Column) -> Column:
    """``path`` without empty, ``.`` and resolvable ``..`` steps; nothing left is ``.``."""
    absolute = path.startswith("/")
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    start = F.array().cast("array<string>")

    def step(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        up = (s == "..") & (F.size(done) > 0) & (F.coalesce(last, F.lit("")) != "..")
        return F.when(up, F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when((s == "..") & (F.size(done) == 0) & absolute, done).otherwise(F.concat(done, F.array(s)))

    joined = F.array_join(F.aggregate(steps, start, step), "/")
    return F.when(absolute, F.concat(F.lit("/"), joined)).otherwise(F.when(joined == "", F.lit(".")).otherwise(joined))


def resolve(base_dir: Column, path: Column) -> Column:
    """``path`` seen from ``base_dir``, collapsed; an absolute path wins."""
    return collapse(F.when(path.startswith("/") | (base_dir == ""), path).otherwise(F.concat_ws("/", base_dir, path)))


@F.pandas_udf(T.StringType())
def resolve_any(base_dir: pd.Series, path: pd.Series) -> pd.Series:
    """The same by the standard library; for differential checks."""
    return pd.Series([None if b is None or p is None else posixpath.normpath(posixpath.join(b, p)) for b, p in zip(base_dir, path, strict=True)])


def absolute_url(url: Column, base: str = SITE_URL) -> Column:
    """RFC 3986 resolution against a fixed base. Root-relative paths without dot steps are a plain expression; the rest goes
    through the standard library in Arrow batches."""

    @F.pandas_udf(T.StringType())
    def by_library(urls: pd.Series) -> pd.Series:
        return urls.map(lambda u: None if u is None else urljoin(base, u))

    root = base.rstrip("/") if base.count("/") <= 3 else base[: base.index("/", 8)]
    return F.when(url.rlike(r"^/[A-Za-z0-9_-][A-Za-z0-9_/-]*$") & ~url.contains("//"), F.concat(F.lit(root), url)).otherwise(by_library(url))


def parse_size(size: Column) -> Column:
    """``WIDTHxHEIGHT`` as (width, height), null unless there are two parts."""
    parts = F.split(F.lower(size), "x")
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("width"), parts[1].alias("height")))


def header_list(header: Column, default: str = "") -> Column:
    """A request header's comma-separated items, trimmed; quality values are not read."""
    return F.transform(F.split(F.coalesce(header, F.lit(default)), ","), lambda item: F.trim(item))


def percent_saved(before: Column, after: Column) -> Column:
    return (before - after) / before * 100


def toc_indent(level: Column, icon_width: int = TOC_ICON_WIDTH) -> Column:
    """Pixels that an entry is indented by."""
    return level * (icon_width + 4) + 4
