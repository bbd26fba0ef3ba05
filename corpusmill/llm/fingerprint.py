"""Document fingerprints (I-Match) in DataFrame operations only.

Terms are hashed to 2**22 ids. The lexicon keeps the ids whose document frequency, as a share of all documents, lies in a
band, that is, whose inverse document frequency does. Since the lower end is a share, at most (mean distinct terms of a
document) / (that share) ids can be in it, and as a bitmap the lexicon has 2**22 bits for any corpus.

Several randomised subsets of the lexicon are fixed by hashing: on each of four levels, which keep all, a quarter, a
sixteenth and a 64th of the ids, every id is in one of 16 or 32 subsets. They are small and, on a level, disjoint, where plain
I-Match takes large, overlapping ones: a large subset's hash changes with nearly any edit and tells only equal from unequal,
many small ones make likeness gradual. The cost: a code says less (a subset in which a document has no term says nothing),
so it takes a number of them, and a document with few terms in the band has few. A document's code for a subset is a hash of
its sorted distinct terms in it. Likeness is the share of equal codes among the subsets in which either document has a term,
on the sparsest levels that have enough of them (on all, if none have): so it is gradual for short and for long documents.

The next document is found in ranges of the order by id and text hash, with bounds taken from a sample of it, so that their
sizes do not depend on how ids are spread; texts are shuffled once, by range.

Edge cases: null and empty texts have no terms; a text without terms in the band has one code from all its terms, compared
as a whole; equal fingerprints have likeness 1; equal texts have equal fingerprints; very long texts are read whole; null
ids come first, equal ids in the order of their texts' hashes, and each row is its own document; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm import bitmaps

BITS = 22
#: Subsets of each level; level l keeps one id in 4**l.
SLOTS = (16, 32, 32, 32)
#: A level, with the sparser ones, decides on likeness if at least so many of its subsets have terms.
ENOUGH = 12
#: Ranges of document order; their number is bounded, so what is known of each can be broadcast. Rows sampled for a bound.
MOST_RANGES, LEAST_ROWS, SAMPLED = 1 << 15, 128, 4
#: Bounds that are compared one by one on each level of the search for a range.
FANOUT = 32


def term_ids(text: Column) -> Column:
    """Distinct hashed terms (runs of letters and digits, lower case) of a text; what no term is hashes like the empty string."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(1 << BITS)).cast("int")))


def lexicon(docs: DataFrame, text: str = "text", least: float = 0.002, most: float = 0.2) -> np.ndarray:
    """The bitmap, as 64-bit words, of the ids whose share of documents is in [least, most]."""
    total = docs.count()
    ids = docs.select(F.explode(term_ids(F.col(text))).alias("id")).groupBy("id").agg(F.count("*").alias("df"))
    words = ids.where(F.col("df").between(least * total, most * total)).groupBy(F.shiftright("id", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, id & 63)")).alias("bits"))
    out = np.zeros(1 << (BITS - 6), np.int64)
    for word, bits in words.collect():
        out[word] = bits
    return out


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def _hash24(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(1 << 24)).cast("int")


def _level(level: int, band: Column) -> Column:
    """The codes of one level's subsets."""
    kept = band if not level else F.filter(band, lambda t: F.pmod(F.hash(t, F.lit(100 + level)), F.lit(4**level)) == 0)
    member = lambda b, k: F.filter(b, lambda t: F.pmod(F.hash(t, F.lit(level)), F.lit(SLOTS[level])) == k)
    code = lambda b: F.when(F.size(b) > 0, _hash24(b))
    return _let(kept, lambda b: F.transform(F.array(*map(F.lit, range(SLOTS[level]))), lambda k: _let(member(b, k), code)))


def codes(text: Column, bitmap: Column) -> Column:
    """One code per subset (null: no term in it), and last a code of all terms where none is in the lexicon (else null)."""
    in_band = lambda t: F.get(bitmap, F.shiftright(t, 6)).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63))) != 0
    whole = lambda ids, band: F.array(F.when(F.size(band) == 0, _hash24(F.sort_array(ids))))
    return _let(term_ids(text), lambda ids: _let(F.sort_array(F.filter(ids, in_band)), lambda band: F.concat(*(_level(level, band) for level in range(len(SLOTS))), whole(ids, band))))


def text_of(code: Column) -> Column:
    """A fingerprint as text: six hexadecimal digits a subset."""
    return F.array_join(F.transform(code, lambda c: F.coalesce(F.lower(F.lpad(F.hex(c), 6, "0")), F.lit("-"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal codes among the subsets in which either has one; 1 if there are none at all."""
    same = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce((x == y).cast("int"), F.lit(0))))

    def share(known: Column, least: int) -> Column:
        return F.when(F.size(known) >= least, F.aggregate(known, F.lit(0), lambda n, s: n + s) / F.size(known))

    def decide(all_of: Column) -> Column:
        some = lambda part: F.filter(part, lambda s: s.isNotNull())
        levels = [share(some(F.slice(all_of, 1 + sum(SLOTS[:level]), sum(SLOTS[level:]))), ENOUGH) for level in reversed(range(len(SLOTS)))]
        return F.coalesce(*levels, share(some(all_of), 1), F.lit(1.0))

    return _let(same, decide)


def bounds_of(rows: DataFrame) -> list[tuple[int, int]]:
    """Lower bounds (key, hash) of ranges of similar numbers of rows, all but the first range's, from a sample by hash of at
    most about ``SAMPLED`` times as many rows as there are ranges."""
    n = rows.count()
    parts = max(1, min(MOST_RANGES, n // LEAST_ROWS))
    share = min(1.0, SAMPLED * parts / max(n, 1))
    sample = rows.select("order.key", "order.hash").where(F.pmod(F.xxhash64("key", "hash", F.lit(5)), F.lit(1 << 30)) < int(share * (1 << 30)))
    found = sorted(map(tuple, sample.distinct().collect()))
    return found[SAMPLED - 1 :: SAMPLED] if parts > 1 else []


def range_of(order: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds are not above ``order``: a search down a tree of constant arrays."""
    levels = [bounds]  # each level has every FANOUT-th bound of the one below
    while len(levels[-1]) > FANOUT:
        levels.append(levels[-1][FANOUT - 1 :: FANOUT])
    found = F.lit(0)
    for level in reversed(levels):
        text = "[" + ",".join(f'{{"key":{k},"hash":{h}}}' for k, h in level) + "]"
        known = F.from_json(F.lit(text), "array<struct<key:bigint,hash:bigint>>")
        step = lambda at, known=known: at * FANOUT + F.size(F.filter(F.slice(known, at * FANOUT + 1, FANOUT), lambda b: b <= order))
        found = _let(found, step)
    return found.cast("long")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (part, key, text, guest) such that each part is a run of documents in ascending order, followed by a copy (guest)
    of the first document after it; the last part's guest is the first document of all. Texts are shuffled once."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).withColumn("order", F.struct(F.coalesce("key", F.lit(-(1 << 63))).alias("key"), F.xxhash64("text").alias("hash")))
    rows = rows.withColumn("part", range_of(F.col("order"), bounds_of(rows)))
    firsts = rows.groupBy("part").agg(F.min("order").alias("order"))
    every = Window.partitionBy(F.lit(0)).orderBy("part")  # at most MOST_RANGES rows
    firsts = firsts.select("order", F.coalesce(F.lag("part").over(every), F.max("part").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("before"))
    rows = rows.join(F.broadcast(firsts), "order", "left")
    guests = F.when(F.col("before").isNotNull(), F.array(F.struct("part", F.lit(False).alias("guest")), F.struct(F.col("before").alias("part"), F.lit(True).alias("guest")))).otherwise(F.array(F.struct("part", F.lit(False).alias("guest"))))
    return rows.select("key", "text", "order", F.explode(guests).alias("to")).select("to.part", "to.guest", "key", "text", "order")


def compare_with_next(docs: DataFrame, bits: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited (the text whose last half is replaced by the next document's start), code, edited_code and
    next_code of every document."""
    bitmap = bitmaps.column_of(bits)
    rows = with_next(docs, key, text).repartition("part").withColumn("code", codes(F.col("text"), bitmap))
    order = Window.partitionBy("part").orderBy("guest", "order", F.coalesce("text", F.lit("")))
    rows = rows.withColumns({"next_text": F.lead("text").over(order), "next_code": F.lead("code").over(order)}).where(~F.col("guest"))
    own, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(own, F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select(F.col("key").alias(key), n.cast("long").alias("n_chars"), edited.alias("edited"), "code", "next_code")
    return rows.withColumn("edited_code", codes(F.col("edited"), bitmap))
