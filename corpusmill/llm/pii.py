"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are the matches of fixed rules for the base kinds (email, ip, card, phone), and identifiers whose own form shows a
secret (``SECRET_LEAST`` characters and more, in which letters and digits take turns ``SECRET_TURNS`` times and more). The
two tokens before an occurrence are its lexical pattern. On the graph of patterns and instances, each round scores a pattern
by the summed score of the instances that follow it over *all* occurrences of its two tokens in the corpus, keeps patterns
of high confidence that several different instances support, and scores identifiers after them; identifiers that score high
join the instances of the next round, and patterns that they are the first to support are then counted too. Identifiers that
the last round's trusted patterns vouch for become spans of kind ``id``, wherever they occur; a seed that no trusted pattern
vouches for does not.

Tokens are cut at white space, quotes and brackets, and around ``=`` and ``:``; letter case does not count. So ``token = "X``,
``Token="X`` and ``token = X`` have the same pattern before X. A pattern's tokens lie within the ``CONTEXT`` characters before an
occurrence, whatever those hold, other occurrences too. An identifier is a whole run of ASCII letters, digits, ``_`` and ``-``
of five characters or more with a digit in it, that starts and ends with a letter or digit, and lies in no base match.

Only occurrences, a small share of the text, and counts of token pairs are shuffled; texts are read where they lie. The
support that lets a pattern be counted is the same at every size of the corpus, and all that have it are counted, or shown by
a part of their count to fall short of the confidence; only a bitmap of fixed size goes to all tasks.

Positions are code points, ends exclusive. Edge cases: null and empty texts have no spans; equal rows (same key and text)
get equal results, one row each; rows that share a key but not their text are kept apart; long runs of digits, dots or
letters are matched without recursion; an empty table gives an empty result; other columns are ignored, and travel along in
``attach``, which refuses a column named ``spans``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm import bitmaps
from corpusmill.session import drop_materialised, materialise

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"
#: Possessive repeats and look-behinds only spare retries that cannot match; the matches are those of the plain patterns.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    FOUND: r"(?<![A-Za-z0-9_-])(?=[A-Za-z0-9_-]{5})(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9][A-Za-z0-9_-]*+(?<=[A-Za-z0-9])",
}
#: What a text must have for a kind's pattern to be tried.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", FOUND: "[0-9]"}
#: Where tokens are cut.
CUT = r"[\s\"'`()\[\]{}<>]+|(?<=[=:])|(?<=[^\s\"'`()\[\]{}<>=:])(?=[=:])"
#: Characters before an occurrence that its pattern may lie in; no match has less than five, so so many neighbours reach.
CONTEXT, NEIGHBOURS = 200, 40
SECRET_LEAST, SECRET_TURNS = 20, 6


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)
    weight = F.transform(F.sequence(F.lit(1), n), lambda i: digits.substr(n - i + 1, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(weight, F.lit(0), lambda total, x: total + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})".replace("0*+", "0*")
    card = F.length(digits).between(13, 19)
    return (
        F.when(kind == "ip", match.rlike(rf"^{part}(?:\.{part}){{3}}$"))
        .when(kind == "card", card & F.when(card, luhn(digits)).otherwise(False))
        .when(kind == "phone", F.length(digits).between(9, 15))
        .otherwise(True)
    )


def secret(value: Column) -> Column:
    """Whether a string's own form shows a secret."""
    turns = F.size(F.split(F.regexp_replace(value, "[_-]", ""), "(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])", -1)) - 1
    return (F.length(value) >= SECRET_LEAST) & (turns >= SECRET_TURNS)


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), CUT, -1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def pattern_of(context: Column) -> Column:
    """The last two tokens of what precedes an occurrence; null if it goes on with the last one, or they may be cut off."""

    def two(t: Column, whole: Column) -> Column:
        first, second, rest = F.element_at(t, -3), F.element_at(t, -2), F.element_at(t, -1)
        return F.when(whole, F.when((rest == "") & (first != "") & (second != ""), F.concat_ws(" ", first, second)))

    return _let(context, lambda c: _let(tokens(c), lambda t: two(t, F.size(t) >= F.when(F.length(c) < CONTEXT, 3).otherwise(4))))


def _matches(text: Column, kind: str) -> Column:
    """The kind's matches in order: kind, pos, gap (characters since the match before), match, pattern."""
    both = F.struct(F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)).alias("found"), F.split(text, PATTERNS[kind], -1).alias("pieces"))

    def context(found: Column, pieces: Column, i: Column, gap: Column) -> Column:
        first = F.greatest(i - NEIGHBOURS, F.lit(0))
        before = F.zip_with(F.slice(pieces, first + 1, i - first), F.slice(found, first + 1, i - first), lambda p, m: F.concat(F.right(p, F.lit(CONTEXT)), m))
        return F.right(F.when((i == 0) | (F.length(gap) >= CONTEXT), gap).otherwise(F.concat(F.array_join(before, ""), gap)), F.lit(CONTEXT))

    def row(found: Column, pieces: Column, m: Column, i: Column) -> Column:
        made = lambda gap: F.struct(F.lit(kind).alias("kind"), i.alias("pos"), F.length(gap).alias("gap"), m.alias("match"), pattern_of(context(found, pieces, i, gap)).alias("pattern"))
        return _let(F.get(pieces, i), made)

    rows = _let(both, lambda x: F.transform(x["found"], lambda m, i: row(x["found"], x["pieces"], m, i)))
    return F.when(text.rlike(NEEDS[kind]), rows).otherwise(F.array().cast("array<struct<kind:string,pos:int,gap:int,match:string,pattern:string>>"))


def occurrences(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All valid base matches and identifier-like strings outside them: key, text_hash, kind, start, end, value, pattern,
    copies (how many rows are the same)."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("text_hash"), F.explode(F.concat(*(_matches(F.col(text), k) for k in PATTERNS))).alias("m")).select("key", "text_hash", "m.*")
    rows = rows.groupBy("key", "text_hash", "kind", "pos").agg(*(F.first(c).alias(c) for c in ("gap", "match", "pattern")), F.count("*").alias("copies"))
    order = Window.partitionBy("key", "text_hash", "kind").orderBy("pos")
    end = F.sum(F.col("gap").cast("long") + F.length("match")).over(order)
    rows = rows.withColumn("end", end).withColumn("start", F.col("end") - F.length("match")).where(valid(F.col("kind"), F.col("match")))
    base = F.col("kind") != FOUND
    near = Window.partitionBy("key", "text_hash").orderBy("start", "end", "kind")
    before = F.max(F.when(base, F.col("end"))).over(near.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(base, F.col("start"))).over(Window.partitionBy("key", "text_hash").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumns({"before": before, "after": after}).where(base | ((F.coalesce("before", F.lit(-1)) <= F.col("start")) & (F.coalesce("after", F.col("end")) >= F.col("end"))))
    return rows.select("key", "text_hash", "kind", "start", "end", F.col("match").alias("value"), "pattern", "copies")


def pattern_counts(docs: DataFrame, patterns: DataFrame, text: str = "text", least_confidence: float = 0.6) -> DataFrame:
    """Occurrences in the whole corpus of the two tokens of each of ``patterns`` (pattern, ceiling: how often any identifier
    follows it) that can reach the confidence: pattern, total.

    They are counted in a part of the texts first, then in a larger one, at last in all: what occurs in a part alone so often
    that the ceiling is too small a share of it cannot reach the confidence over all, whichever identifiers are trusted. So
    frequent pairs of tokens drop out early, and nothing that could be trusted does. A bitmap of fixed size drops most pairs
    that are no pattern before they become rows; what passes is counted per task, shuffled by hash and joined, however many
    patterns there are."""
    wanted = patterns.select("pattern", "ceiling", F.xxhash64(F.element_at(F.split("pattern", " "), 1), F.element_at(F.split("pattern", " "), 2)).alias("pair"))
    for part in (1, 16, 256):  # of 256
        wanted = materialise(wanted, "pii-wanted")
        may = bitmaps.test(bitmaps.of(wanted.select("pair"), "pair"))
        cut = docs.where(F.col(text).isNotNull() & (F.pmod(F.xxhash64(text), F.lit(256)) < part)).select(tokens(F.col(text)).alias("w"))
        pairs = F.zip_with(F.slice("w", 1, F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", 2, F.size("w")), lambda a, b: F.xxhash64(a, b))
        counts = cut.select(F.explode(F.filter(pairs, may)).alias("pair")).groupBy("pair").agg(F.count("*").alias("total"))
        wanted = wanted.join(counts, "pair", "left").where(F.coalesce("total", F.lit(0)) * least_confidence <= F.col("ceiling"))
        wanted = wanted if part == 256 else wanted.drop("total")
    return wanted.where("total is not null").select("pattern", "total")


def discover(docs: DataFrame, found: DataFrame, text: str = "text", rounds: int = 3, least_confidence: float = 0.6, least_support: int = 5) -> DataFrame | None:
    """The values (strings outside the base kinds) that the patterns vouch for: value, score; None if there are none."""
    known = found.where(F.col("pattern").isNotNull())
    edges = known.groupBy("pattern", "value").agg(F.sum("copies").alias("n"), F.max(F.col("kind") != FOUND).alias("base"))
    edges = materialise(edges.withColumn("seed", F.col("base") | secret(F.col("value"))), "pii-edges")
    seeds = edges.where("seed").groupBy("value").agg(F.lit(1.0).alias("score"))
    instances, made = seeds, [edges]
    accepted = counted = asked = None

    def kept(frame: DataFrame, label: str) -> DataFrame:
        made.append(materialise(frame, f"pii-{label}"))
        return made[-1]

    ceilings = kept(edges.groupBy("pattern").agg(F.sum("n").alias("ceiling"), F.count("*").alias("values")).where(F.col("values") >= least_support).drop("values"), "ceilings")
    for _ in range(rounds):
        scored = kept(edges.join(instances, "value").groupBy("pattern").agg(F.sum(F.col("n") * F.col("score")).alias("hits"), F.count("*").alias("support")).where(F.col("support") >= least_support), "patterns")
        fresh = kept(scored.select("pattern") if asked is None else scored.select("pattern").join(asked, "pattern", "left_anti"), "fresh")
        if not fresh.isEmpty():  # those that this round's instances are the first to support
            more = kept(pattern_counts(docs, fresh.join(ceilings, "pattern"), text, least_confidence), "counts")
            counted, asked = (more, fresh) if asked is None else (counted.unionByName(more), asked.unionByName(fresh))
        if asked is None:
            break
        trusted = kept(scored.join(counted, "pattern").select("pattern", F.least(F.lit(1.0), F.col("hits") / F.col("total")).alias("confidence")).where(F.col("confidence") >= least_confidence), "trusted")
        new = edges.where("not base").join(trusted, "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))).alias("score"))
        accepted = kept(new.where(F.col("score") >= least_confidence), "instances")
        if accepted.isEmpty():
            break
        instances = kept(seeds.unionByName(accepted).groupBy("value").agg(F.max("score").alias("score")), "instances")
    out = None if accepted is None or accepted.isEmpty() else accepted
    drop_materialised(*(frame for frame in made if frame is not out))
    return out


def find(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """One row per distinct (key, text_hash) that has spans: ``spans``, an array of (rank, start, end, kind, value) in order
    of kind as listed, then start. ``options`` are those of :func:`discover`."""
    found = materialise(occurrences(docs, text, key), "pii-occurrences")
    new = discover(docs, found, text, **options)
    spans = found.where(F.col("kind") != FOUND)
    if new is not None:
        spans = spans.unionByName(found.where(F.col("kind") == FOUND).join(new.select("value"), "value", "left_semi").select(*found.columns))
    rank = F.array_position(F.array(*map(F.lit, (*KINDS, FOUND))), F.col("kind")).cast("int")
    out = materialise(spans.groupBy("key", "text_hash").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "start", "end", "kind", "value"))).alias("spans")), "pii-spans")
    drop_materialised(found, *([] if new is None else [new]))
    return out


def attach(docs: DataFrame, spans: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text_hash`` and their ``spans`` (empty where there are none). What ``docs`` has besides travels along."""
    if "spans" in docs.columns:
        raise ValueError("there is a column spans already")
    right = spans.select(F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    none = F.array().cast(right.schema["__spans"].dataType)
    left = docs if "text_hash" in docs.columns else docs.withColumn("text_hash", F.xxhash64(text))
    apart = None
    if text in docs.columns:  # most texts have nothing that any kind needs: they are not shuffled
        may = F.coalesce(F.col(text).rlike("[0-9@]"), F.lit(False))
        left, apart = left.where(may), left.where(~may).withColumn("spans", none)
    joined = left.join(right, F.col(key).eqNullSafe(F.col("__key")) & (F.col("text_hash") == F.col("__hash")), "left")
    joined = joined.withColumn("spans", F.coalesce("__spans", none)).drop("__key", "__hash", "__spans")
    return joined if apart is None else joined.unionByName(apart)


def redact(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in angle brackets; of overlapping spans the union goes, named by the
    first of them."""
    ordered = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        mark = F.when(s["start"] >= acc["at"], F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], mark).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))))
