"""N-gram Jaccard join with signature trees.

A document's set is that of its distinct k-word shingles, hashed to 64 bits; equal sets are one class. Two sets link when
their intersection is at least ``num / den`` of their union; a document's component is what links reach.

1. *Blocks.* Of sets of similar size, a linked pair differs in at most d shingles. Shingles are dealt to more than d groups
   by hash, so in some groups, at least as many as the set fills beyond d, both sets hold the same shingles. Each set gives
   a key for each group it fills. Keys are combined per task before they are shuffled, packed as bytes, and sorted there. A
   set that shares fewer keys than a link needs is done; most sets share none or a few by chance. The others are joined to
   blocks (connected components of sets that share a key). Links never leave a block.
2. *Signature trees.* Within a block, nodes hold the OR of their sets' token bitmaps, their size range and the tokens that
   collisions hide. Both sides of a join are descended together; a pair of nodes whose largest possible overlap, or whose
   sizes, rule out a link is dropped, and so is a pair whose sets are one component already. What remains is checked on the
   sets themselves.
3. *Large blocks* are cut into tiles. Tiles are joined within themselves first, then one set of each component found. Where
   a block still has several components, it is joined by the sets of each key that differ in component, or, where that
   would be more, as a whole. More than a tile of sets is joined by pairs of tiles that may hold sets of different
   components and similar size. Every pair that could link is thus examined, and no task holds more than two tiles.

Rows leave a task as links of a spanning forest, at most one per set and task, never as pairs.

Edge cases: null, empty and wordless texts have the empty set and link with nothing; with fewer than k words the sequence
is one shingle; rows that share their id are told apart by their sets, and may be in different components; a set that only
rows without an id have links with no other; an empty table gives an empty result; extra columns are ignored; whole texts
are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bitmaps
from corpusmill.llm import words as W
from corpusmill.llm.components import connected
from corpusmill.llm.skew import with_unique
from corpusmill.session import drop_materialised, free_shuffles, materialise, share_code

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
TILE = 512
#: Tasks that the tile pairs of one size class of a block are dealt to.
DEALS = 32
#: Keys that a task gathers before it sends them on.
GATHER = 400_000
#: Characters of text whose keys one task pairs.
BUCKET = 12_500_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that scatters well."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): each text's sorted distinct shingles."""
    bounds, index, distinct = W.split_words(W.mapped(texts, W.SPACES_LOWER))
    word = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), np.uint64, len(distinct))[index]
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(n)), n)
    left = bounds[1:][owner] - np.arange(len(index))  # words from here to the end
    value = np.zeros(len(index), np.uint64)
    for j in range(k):
        use = left > j
        nxt = np.zeros(len(index), np.uint64)
        nxt[use] = word[np.flatnonzero(use) + j]
        value = np.where(use, mix(value * _A + nxt + np.uint64(j + 1)), value)
    first = np.zeros(len(index), bool)
    first[bounds[:-1][n > 0]] = True
    real = (left >= k) | (first & (n[owner] < k))
    owner, value = owner[real], value[real]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.concatenate([[0], np.cumsum(np.bincount(owner[new], minlength=len(n)))]).astype(np.int64)


def digests(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set; empty sets have 0."""
    raw, b = values.tobytes(), bounds.tolist()
    both = [xxhash.xxh3_128_intdigest(raw[8 * x : 8 * y]) if y > x else 0 for x, y in zip(b[:-1], b[1:], strict=True)]
    return np.array([d & ((1 << 64) - 1) for d in both], np.uint64).view(np.int64), np.array([d >> 64 for d in both], np.uint64).view(np.int64)


@dataclass(frozen=True)
class Scheme:
    """Sets of ``low`` shingles or more, as the smaller of a pair, up to the next scheme's."""

    number: int
    low: int
    high: int  # exclusive
    d: int  # largest difference of a linked pair
    groups: int


def scheme(number: int, num: int, den: int) -> Scheme:
    low, high = math.ceil(1.5**number), math.ceil(1.5 ** (number + 1))
    a = high - 1  # |x| <= a, |y| <= a * den / num; the overlap is at least (|x| + |y|) * num / (num + den)
    d = (den - num) * (a + a * den // num) // (den + num)
    return Scheme(number, low, high, d, (d + 1) * 27 // 20 + 2)


def number_of(n: int) -> int:
    c = int(math.log(n) / math.log(1.5))
    while math.ceil(1.5 ** (c + 1)) <= n:
        c += 1
    while math.ceil(1.5**c) > n:
        c -= 1
    return c


def keys(values: np.ndarray, bounds: np.ndarray, classes: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, class, needs): the keys of each set's groups that hold shingles, for the scheme of its size and, if it may be
    the larger of a pair there, the one below. A key's lowest bit is the scheme's parity. needs[i, parity]: how many of its
    keys set i shares at least with a set that it links to: its groups with shingles less those that may differ. (Sets with
    too few such groups give their empty groups too, and need one.) Schemes in which linked sets cannot differ give none:
    equal sets are one class already."""
    n = np.diff(bounds)
    sizes, inverse = np.unique(n, return_inverse=True)
    own = np.array([number_of(x) if x else -1 for x in sizes.tolist()])
    low = np.array([math.ceil(1.5**c) if c >= 0 else 0 for c in own.tolist()])
    out_k, out_c, needs = [], [], np.zeros((len(n), 2), np.int64)
    for step in (0, 1):
        number = own[inverse] - step
        fits = (n > 0) & (number >= 0)
        if step:
            fits &= n * num < low[inverse] * den  # some |x| < low has |x| * den >= n * num
        for c in np.unique(number[fits]).tolist():
            s = scheme(c, num, den)
            if s.d == 0:
                continue
            rows = np.flatnonzero(fits & (number == c))
            take = W.ragged(bounds[rows], n[rows])
            v = mix(values[take] ^ np.uint64((c + 1) * int(_A) & (1 << 64) - 1))
            cell = np.repeat(np.arange(len(rows)), n[rows]) * s.groups + ((v >> np.uint64(32)) * np.uint64(s.groups) >> np.uint64(32)).astype(np.int64)
            size = len(rows) * s.groups
            filled = (np.bincount(cell, minlength=size) > 0).reshape(len(rows), s.groups)
            total = np.zeros(size, np.uint64)
            np.add.at(total, cell, mix(v * _A))
            held = filled.sum(axis=1)
            needs[rows, c & 1] = np.maximum(1, held - s.d)
            r, g = np.nonzero(filled | (held <= s.d)[:, None])
            key = mix(total.reshape(len(rows), s.groups)[r, g] * _A + g.astype(np.uint64) * _C + np.uint64(c))
            out_k.append(key & ~np.uint64(1) | np.uint64(c & 1))
            out_c.append(classes[rows[r]])
    return np.concatenate([np.zeros(0, np.uint64), *out_k]), np.concatenate([np.zeros(0, np.int64), *out_c]), needs


def stars(key: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, ...]:
    """(distinct keys, the least member of each; then key, member and least member of all entries of keys that have
    several members)."""
    order = np.lexsort((member, key))
    key, member = key[order], member[order]
    once = np.ones(len(key), bool)
    once[1:] = (key[1:] != key[:-1]) | (member[1:] != member[:-1])
    key, member = key[once], member[once]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    run = np.cumsum(new) - 1
    many = (np.bincount(run) > 1)[run] if len(key) else new
    least = member[new][run] if len(key) else member
    return key[new], member[new], key[many], member[many], least[many]


class Forest:
    """Union-find; the roots of components are told apart by position."""

    def __init__(self, start: np.ndarray):
        _, first, inverse = np.unique(start, return_index=True, return_inverse=True)
        self.up = first[inverse]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


class SignatureTree:
    """Nodes over sets in the order given; a node is (first, last, bitmap, least size, largest size, hidden tokens)."""

    FANOUT = 8

    def __init__(self, sets: list[np.ndarray], order: np.ndarray):
        self.order = order
        width = 1 << max(6, int(4 * max(len(s) for s in sets) - 1).bit_length())
        bits = np.zeros((len(order), width // 8), np.uint8)
        for row, i in enumerate(order.tolist()):
            at = (sets[i] >> np.uint64(40)).astype(np.int64) & (width - 1)
            np.bitwise_or.at(bits[row], at >> 3, (1 << (at & 7)).astype(np.uint8))
        bits = bits.view(np.uint64)
        size = np.array([len(sets[i]) for i in order])
        hidden = size - np.bitwise_count(bits).sum(axis=1)
        self.levels = [(bits, size, size, hidden)]
        while len(self.levels[-1][0]) > 1:
            b, lo, hi, h = self.levels[-1]
            cut = np.arange(0, len(b), self.FANOUT)
            self.levels.append((np.bitwise_or.reduceat(b, cut), np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(h, cut)))

    def children(self, level: int, node: int) -> np.ndarray:
        return np.arange(node * self.FANOUT, min((node + 1) * self.FANOUT, len(self.levels[level - 1][0])))

    def span(self, level: int, node: int) -> tuple[int, int]:
        reach = self.FANOUT**level
        return node * reach, min((node + 1) * reach, len(self.order))


def may_link(a: SignatureTree, la: int, na: np.ndarray, b: SignatureTree, lb: int, nb: np.ndarray, num: int, den: int) -> np.ndarray:
    """For each pair of nodes, whether sizes and the largest possible overlap admit a link."""
    bits_a, lo_a, hi_a, hid_a = (x[na] for x in a.levels[la])
    bits_b, lo_b, hi_b, hid_b = (x[nb] for x in b.levels[lb])
    common = np.bitwise_count(bits_a[:, None, :] & bits_b[None, :, :]).sum(axis=2, dtype=np.int64) + np.minimum(hid_a[:, None], hid_b[None, :])
    overlap = np.minimum(common, np.minimum(hi_a[:, None], hi_b[None, :]))
    return (overlap * (num + den) >= num * (lo_a[:, None] + lo_b[None, :])) & (hi_a[:, None] * den >= lo_b[None, :] * num) & (hi_b[None, :] * den >= lo_a[:, None] * num)


def tree_links(sets: list[np.ndarray], start: np.ndarray, sides: np.ndarray | None, num: int, den: int) -> list[tuple[int, int]]:
    """Links (positions) that join the components ``start`` of sets as far as links allow; with ``sides`` only links
    between side 0 and side 1 are sought. Found by dual traversal of signature trees."""
    forest, found = Forest(start), []
    lead = np.array([s[0] for s in sets], np.uint64)
    size = np.array([len(s) for s in sets])

    def tree(which: np.ndarray) -> SignatureTree:
        return SignatureTree(sets, which[np.lexsort((size[which], lead[which], start[which]))])

    if sides is None:
        left = right = tree(np.arange(len(sets)))
    else:
        left, right = tree(np.flatnonzero(sides == 0)), tree(np.flatnonzero(sides == 1))

    def joined(level_a: int, x: int, level_b: int, y: int) -> bool:
        (a0, a1), (b0, b1) = left.span(level_a, x), right.span(level_b, y)
        root = forest.root(int(left.order[a0]))
        return all(forest.root(i) == root for i in left.order[a0:a1].tolist()) and all(forest.root(i) == root for i in right.order[b0:b1].tolist())

    stack = [(len(left.levels) - 1, 0, len(right.levels) - 1, 0)]
    while stack:
        la, x, lb, y = stack.pop()
        if la == 0 and lb == 0:
            i, j = int(left.order[x]), int(right.order[y])
            if i != j and forest.root(i) != forest.root(j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if both * den >= num * (len(sets[i]) + len(sets[j]) - both):
                    forest.join(i, j)
                    found.append((i, j))
            continue
        if joined(la, x, lb, y):
            continue
        down_a = left.children(la, x) if la >= lb and la else np.array([x])
        down_b = right.children(lb, y) if lb >= la and lb else np.array([y])
        na, nb = la - (la >= lb and la > 0), lb - (lb >= la and lb > 0)
        ok = may_link(left, na, down_a, right, nb, down_b, num, den)
        nexts = [(na, int(down_a[p]), nb, int(down_b[q])) for p, q in zip(*np.nonzero(ok), strict=True) if not (left is right and na == nb and down_a[p] > down_b[q])]
        # pairs near the diagonal last, so that they are taken first: neighbours are likely copies
        stack.extend(sorted(nexts, key=lambda t: -abs(t[1] - t[3])))
    return found


def _block_links(grouped: DataFrame, by: list[str], k: int, num: int, den: int) -> DataFrame:
    """(a, b): links found within the groups of ``by`` of rows (class, start, side, text); start tells components known.
    side: 0 or 1, or null where all pairs of the group are meant."""
    names = [*by, "class", "start", "side", "text"]
    rows = grouped.select(*names).repartition(*by).sortWithinPartitions(*by, F.col("side").asc_nulls_first(), "class")

    def solve(part: list[tuple]) -> list[tuple[int, int]]:
        texts = pa.array([r[3] for r in part], pa.large_string())
        values, bounds = shingles(texts, k)
        keep, sets = [], []
        own, _ = digests(values, bounds)
        for i, (x, y) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if own[i] == part[i][0] and y > x:  # rows that share an id may have another text
                keep.append(part[i])
                sets.append(values[x:y])
        known = [r[2] for r in keep]
        if len(keep) < 2 or (None not in known and len(set(known)) < 2):
            return []
        sides = None if known[0] is None else np.array(known)
        return [(keep[i][0], keep[j][0]) for i, j in tree_links(sets, np.array([r[1] for r in keep], np.int64), sides, num, den)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part, found = None, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(len(names))]
            for row in zip(*columns, strict=True):
                if row[: len(by)] != at:
                    found += solve(part) if len(part) > 1 else []
                    at, part = row[: len(by)], []
                part.append(row[len(by) :])
        found += solve(part) if len(part) > 1 else []
        del part
        W.trim()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def link(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: ``key``, n_shingles, component_id: the smallest key that links reach, itself included."""
    spark = docs.sparkSession
    share_code(spark)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil((rows.agg(F.sum(F.length("text"))).first()[0] or 0) / BUCKET))

    # each document's class, and its keys, packed by bucket
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key_, least = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
            held.clear()
            key_, least, *many = stars(key_, least)
            where = (key_ >> np.uint64(33)).astype(np.int64) % buckets
            order = np.argsort(where, kind="stable")
            cut = np.concatenate([[0], np.cumsum(np.bincount(where, minlength=buckets))]).tolist()
            sent = [(i, key_[order[x:y]].tobytes(), least[order[x:y]].tobytes()) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if y > x]
            sent.append((-1, many[0].tobytes(), np.concatenate(many[1:]).tobytes()))
            n = len(sent)
            return pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 6, pa.array([s[0] for s in sent], pa.int64()), pa.array([s[1] for s in sent], pa.binary()), pa.array([s[2] for s in sent], pa.binary())], names=columns)

        for batch in W.slices(batches, "text", 2 << 20):
            values, bounds = shingles(W.texts_of(batch, "text"), k)
            h, g = digests(values, bounds)
            n = batch.num_rows
            _, first, same = np.unique(h, return_index=True, return_inverse=True)
            starts, length = bounds[:-1][first], np.diff(bounds)[first]
            *entries, needs = keys(values[W.ragged(starts, length)], np.concatenate([[0], np.cumsum(length)]), h[first], num, den)
            held.append(tuple(entries))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(h), pa.array(g), pa.array(np.diff(bounds)), pa.array(needs[same, 0]), pa.array(needs[same, 1]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names=columns)
            if sum(len(x) for x, _ in held) > GATHER:
                yield flush()
        if held:
            yield flush()

    columns = ["key", "class", "check", "n", "even", "odd", "bucket", "keys", "members"]
    seen = materialise(rows.mapInArrow(describe, "key long, class long, check long, n long, even long, odd long, bucket long, keys binary, members binary"), "shingle-keys")
    described = materialise(seen.where("bucket is null").select("key", F.when(F.col("n") > 0, F.col("class")).alias("class"), F.when(F.col("n") > 0, F.col("check")).alias("check"), "n", "even", "odd"), "shingle-classes")

    def rows_of(*columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], names=["g", "a", "b"])

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key_, member = [], []
        for batch in batches:
            key_ += [np.frombuffer(x, np.uint64) for x in batch.column("keys").to_pylist()]
            member += [np.frombuffer(x, np.int64) for x in batch.column("members").to_pylist()]
        if key_:
            batch = None
            key_, member = np.concatenate(key_), np.concatenate(member)  # the parts go before the whole is sorted
            yield rows_of(*stars(key_, member)[2:])
            del key_, member
            W.trim()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("keys").to_pylist(), batch.column("members").to_pylist(), strict=True):
                yield rows_of(np.frombuffer(x, np.uint64), *np.split(np.frombuffer(y, np.int64), 2))

    # (key, class, least class): the keys that several sets have, with all that have them
    packed = seen.where("bucket >= 0").select("bucket", "keys", "members").repartition(buckets, "bucket").select("keys", "members")
    shared = materialise(packed.mapInArrow(pair, "g long, a long, b long").unionByName(seen.where("bucket = -1").select("keys", "members").mapInArrow(unpack, "g long, a long, b long")), "shingle-shared")
    # sets with fewer shared keys than a link needs are done; most that met by chance are
    counts = shared.select("g", "a").distinct().groupBy("a").agg(F.count_if(F.col("g") % 2 == 0).alias("n_even"), F.count_if(F.col("g") % 2 != 0).alias("n_odd"))
    needs = described.where("class is not null").groupBy(F.col("class").alias("a")).agg(F.max("even").alias("even"), F.max("odd").alias("odd"))
    able = counts.join(needs, "a").select("a", (F.col("n_even") >= F.col("even")).alias("even"), (F.col("n_odd") >= F.col("odd")).alias("odd")).where("even or odd")
    left = shared.select("g", "a").distinct().join(able, "a").where(F.when(F.col("g") % 2 == 0, F.col("even")).otherwise(F.col("odd"))).select("g", "a")
    least = left.groupBy("g").agg(F.min("a").alias("b"), F.count("*").alias("c")).where("c > 1").select("g", "b")
    met = materialise(left.join(least, "g"), "shingle-met")
    drop_materialised(shared)
    shared = met
    block = connected(shared, "a", "b").select(F.col("node").alias("class"), F.col("component").alias("block"))
    drop_materialised(seen)
    del seen, packed
    free_shuffles(spark)

    # one document of each class in a block, with its text
    classes = described.where("class is not null").groupBy("class", "check").agg(F.min("key").alias("rep"), F.first("n").alias("n"))
    chosen = materialise(block.join(classes, "class").select("class", "block", "rep", "n"), "shingle-placed")
    sizes = chosen.groupBy("block").agg(F.count("*").alias("size")).where("size > 1")
    chosen = materialise(with_unique(chosen, sizes, ["block"]).where("size > 1").withColumn("tiles", F.ceil(F.col("size") / TILE)), "shingle-sized")
    # texts that are in no block stay where they are
    may = bitmaps.test(bitmaps.of(chosen.select(F.xxhash64("rep").alias("at")), "at"))
    chosen = materialise(chosen.join(rows.where(may(F.xxhash64("key"))), F.col("rep") == F.col("key")).select("class", "block", "n", "tiles", "text"), "shingle-blocks")

    free_shuffles(spark)

    # tiles within themselves
    tiled = chosen.select("block", F.when(F.col("tiles") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("class"), F.col("tiles"))).alias("tile"), "class", F.col("class").alias("start"), F.lit(None).cast("int").alias("side"), "text")
    links = materialise(_block_links(tiled, ["block", "tile"], k, num, den), "shingle-links")

    parts = materialise(connected(links, "a", "b").select(F.col("node").alias("class"), F.col("component").alias("start")), "shingle-parts")

    # what large blocks still have in several components
    large = chosen.where("tiles > 1")
    if not large.isEmpty():
        parts = _join_tiles(large, shared, parts, k, num, den)
    drop_materialised(chosen, shared)
    free_shuffles(spark)

    parts = parts.withColumnRenamed("start", "component")
    members = described.where("class is not null").groupBy("class").agg(F.min("key").alias("rep")).join(parts, "class", "left")
    members = materialise(members.withColumn("component", F.coalesce("component", "class")), "shingle-members")
    least = members.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = with_unique(members, least, ["component"]).select("class", "component_id")
    out = with_unique(described, known, ["class"])
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))


def _join_tiles(large: DataFrame, shared: DataFrame, parts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Components (class, start) by ``parts`` and by the links between the tiles of large blocks.

    What a block still has in several components is compared either as a whole or, if that is less, key by key: sets that
    link share a key.
    """
    ratio = math.log(den / num) if num < den else 1.0

    def with_links(more: DataFrame) -> DataFrame:
        found = connected(parts.select(F.col("class").alias("a"), F.col("start").alias("b")).unionByName(more), "a", "b")
        return materialise(found.select(F.col("node").alias("class"), F.col("component").alias("start")), "shingle-parts")

    ids = materialise(large.select("class", "block", "n"), "shingle-large")
    texts = large.select("class", "text")

    def placed_parts() -> DataFrame:
        return ids.join(parts, "class", "left").withColumn("start", F.coalesce("start", "class"))

    while True:  # one set of each component, as long as that joins many of them
        heads = placed_parts().groupBy("block", "start").agg(F.min("class").alias("class"))
        count = heads.groupBy("block").agg(F.count("*").alias("parts")).where("parts > 1")
        heads = materialise(with_unique(materialise(heads, "shingle-all-heads"), count, ["block"]).where("parts > 1").select("block", "class", "start", F.pmod(F.xxhash64("start", "parts"), F.ceil(F.col("parts") / TILE)).alias("tile"), F.lit(None).cast("int").alias("side")), "shingle-heads")
        more = materialise(_block_links(heads.join(texts, "class"), ["block", "tile"], k, num, den), "shingle-links")
        joined = more.count()
        if joined:
            parts = with_links(more)
        if not joined or joined < 0.25 * heads.count():
            break

    now = materialise(placed_parts(), "shingle-now")
    open_blocks = now.groupBy("block").agg(F.count("*").alias("docs"), F.min("start").alias("lo"), F.max("start").alias("hi")).where("lo <> hi")
    # equal groups once, from the keys alone: joining every key's sets to learn the way takes more rows than the way itself
    groups = shared.groupBy("g", "b").agg(F.count("*").alias("members"), F.struct(F.bit_xor(F.xxhash64("a")).alias("x"), F.bit_xor(F.xxhash64("a", F.lit(1))).alias("y")).alias("mark"))
    groups = groups.groupBy("b", "members", "mark").agg(F.min("g").alias("g")).join(now.select(F.col("class").alias("b"), "block").distinct(), "b")
    groups = materialise(groups.select("g", "block", "members"), "shingle-groups")
    cost = F.when(F.col("members") <= TILE, F.col("members")).otherwise(F.col("members") * F.col("members") / TILE)  # larger groups are tiled, too
    costs = open_blocks.join(groups.groupBy("block").agg(F.sum(cost).alias("by_key")), "block", "left")
    costs = materialise(costs.select("block", (F.coalesce("by_key", F.lit(0)) < F.col("docs") * F.col("docs") / TILE).alias("keyed")), "shingle-costs")
    units = with_unique(now, costs, ["block"]).where("not keyed").select(F.col("block").alias("unit"), "class", "start", "n")
    keyed = costs.where("keyed")
    if not keyed.isEmpty():
        wanted = groups.join(keyed, "block", "left_semi").select("g")
        grouped = materialise(shared.select("g", F.col("a").alias("class")).join(wanted, "g", "left_semi").join(now, "class"), "shingle-grouped")
        apart = grouped.groupBy("g").agg(F.min("start").alias("lo"), F.max("start").alias("hi")).where("lo <> hi").select("g")
        units = units.unionByName(grouped.join(apart, "g", "left_semi").select(F.col("g").alias("unit"), "class", "start", "n"))
    units = materialise(units, "shingle-unsized")
    units = materialise(with_unique(units, units.groupBy("unit").agg(F.count("*").alias("members")), ["unit"]), "shingle-units")
    small = units.where(F.col("members") <= TILE).select("unit", "class", "start", F.lit(None).cast("int").alias("side"))
    more = materialise(_block_links(small.join(texts, "class"), ["unit"], k, num, den), "shingle-links")
    if not more.isEmpty():
        parts = with_links(more)
    now = units.where(F.col("members") > TILE).select(F.col("unit").alias("block"), "class", "n").join(parts, "class", "left").withColumn("start", F.coalesce("start", "class"))
    now = materialise(now, "shingle-now")
    # tiles of one large component each, or of small components together; by size class
    per = materialise(now.groupBy("block", "start").agg(F.count("*").alias("members")), "shingle-per")
    per = with_unique(per, per.groupBy("block").agg(F.count("*").alias("parts")), ["block"]).where("parts > 1").select("block", "start", "members")
    rest = with_unique(now, per, ["block", "start"]).where("members is not null").withColumns({"mixed": F.col("members") <= TILE, "owner": F.when(F.col("members") > TILE, F.col("start")).otherwise(0), "level": F.floor(F.log("n") / ratio + 1e-9).cast("long")})
    rest = materialise(rest.select("block", "class", "start", "mixed", "owner", "level"), "shingle-open")
    if rest.isEmpty():
        return parts
    tile = ["block", "mixed", "owner", "level"]
    cells = materialise(rest.groupBy(*tile).agg(F.ceil(F.count("*") / TILE).alias("cells")), "shingle-cells")
    tiles = cells.select(*tile, F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell")).select("block", F.struct("level", "mixed", "owner", "cell").alias("p"))
    # the tiles of a large block meet those of their own and the next size class, dealt to several tasks
    own = tiles.withColumn("deal", F.pmod(F.xxhash64("block", "p"), F.lit(DEALS))).select("block", "deal", "p", F.explode(F.array(F.col("p.level"), F.col("p.level") + 1)).alias("level"))
    other = tiles.select("block", F.col("p").alias("q"), F.col("p.level").alias("level"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEALS - 1).cast("long"))).alias("deal"))
    apart = F.col("p.mixed") | F.col("q.mixed") | (F.col("p.owner") != F.col("q.owner"))
    pairs = own.join(other, ["block", "level", "deal"]).where((F.col("p") <= F.col("q")) & apart).select("block", "p", "q")
    pairs = materialise(pairs.withColumn("pair", F.monotonically_increasing_id()), "shingle-pairs")
    side = lambda t, n: F.struct(F.col(t).alias("t"), F.lit(n).cast("int").alias("side"))
    ends = pairs.select("block", "pair", F.explode(F.when(F.col("p") == F.col("q"), F.array(side("p", None))).otherwise(F.array(side("p", 0), side("q", 1)))).alias("e")).select("block", "pair", "e.t.*", "e.side")
    placed = rest.join(cells, tile).withColumn("cell", F.pmod(F.xxhash64("class"), "cells"))
    meet = placed.join(ends, [*tile, "cell"]).select("pair", "class", "start", "side").join(texts, "class")
    more = materialise(_block_links(meet, ["pair"], k, num, den), "shingle-links")
    return parts if more.isEmpty() else with_links(more)
