"""Embedding near-duplicates by iterative quantisation.

Rotations are learned on a bounded sample such that the signs of the rotated, centred vectors are balanced codes that lose
little (PCA, then alternating signs and orthogonal Procrustes). A code is cut into chunks, one Hamming table each; vectors
of a label that share a chunk in any table are compared by their original vectors in double precision. A table's width
follows the number of rows, so that buckets stay small, and the number of tables follows the width, so that a pair at the
least cosine is missed by all of them with a chance of ``MISSED`` at most (measured by a test for widths up to 30); further
rotations supply the bits. Vectors of another length than most get the signs of random directions instead, with the same
chances.

Equal vectors of a label are one class. Only what shares a bucket is moved, first as ids, then once with its vector. Buckets
beyond ``tile`` members are cut into tiles, and each pair of tiles is one block, so no task holds more than two tiles; a
block gives one row per vector, never its pairs. A pair is counted only in the first table that it shares.

Edge cases: vectors that are null, zero, or hold null or non-finite components, and rows without a label, link with nothing;
labels of any type are equal if their text is; vectors of different lengths are never compared; rows that share their id are
told apart by label and vector, and may be in different components; ties need no rule, all links count; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.components import connected, stars
from corpusmill.llm.skew import with_unique
from corpusmill.session import drop_materialised, materialise, share_code


def learn(x: np.ndarray, bits: int, seed: int = 11, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): ``bits`` columns, from as many rotations of the leading principal axes as needed.

    Unit vectors are centred unless they share so much of a direction that centring would blow up the angles between
    near-duplicates; then the codes are less balanced, but near-duplicates still agree in them.
    """
    mean = x.mean(axis=0)
    if mean @ mean > 0.2:
        mean = np.zeros_like(mean)
    y = x - mean
    _, axes = np.linalg.eigh(y.T @ y)
    axes = axes[:, ::-1]
    rng, parts = np.random.default_rng(seed), []
    while sum(p.shape[1] for p in parts) < bits:
        rotation = np.linalg.qr(rng.normal(size=(axes.shape[1], axes.shape[1])))[0]
        z = y @ axes
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(z @ rotation >= 0, 1.0, -1.0).T @ z)
            rotation = (u @ w).T
        parts.append(axes @ rotation)
    return mean, np.concatenate(parts, axis=1)[:, :bits]


#: Chance that a pair at the least cosine shares no table.
MISSED = 0.01


def plan(count: int, least: float) -> tuple[int, int]:
    """(width, tables) for so many vectors: buckets of about two unrelated members, and tables enough for ``MISSED``."""
    width = int(np.clip(np.ceil(np.log2(max(2, count))) - 1, 8, 40))
    agree = (1 - np.arccos(np.clip(least, -1, 1)) / np.pi) ** width
    return width, max(6, int(np.ceil(np.log(MISSED) / np.log1p(-min(agree, 0.999)))))


def directions(dim: int, bits: int) -> np.ndarray:
    """Random directions for vectors of a length that no rotation was learned for; the same in every task."""
    return np.random.default_rng([dim, 17]).normal(size=(dim, bits))


def link(vectors: DataFrame, least: float = 0.98, key: str = "vec_id", embedding: str = "embedding", label: str = "label", most_sample: int = 20_000, tile: int = 1024) -> DataFrame:
    """One row per vector: ``key``, n_links, component_id (smallest key reachable by links), kept (it is that one)."""
    spark = vectors.sparkSession
    share_code(spark)
    rows = vectors.select(F.col(key).alias("key"), F.col(embedding).alias("x"), F.xxhash64(F.col(label).cast("string")).alias("label"), F.col(label).isNotNull().alias("labelled"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    good = F.col("x").isNotNull() & F.col("labelled") & finite & F.exists("x", lambda v: v != 0)
    # -0.0 is 0.0
    rows = rows.withColumn("class", F.when(good, F.struct(F.xxhash64("label", F.transform("x", lambda v: v + F.lit(0.0))).alias("h"), F.hash("label", F.transform("x", lambda v: v + F.lit(0.0))).alias("g"))))
    classes = materialise(rows.where(good).groupBy("class").agg(F.min("key").alias("rep"), F.count("*").alias("n"), F.min("x").alias("x"), F.first("label").alias("label")), "vector-classes")
    count, dim = classes.agg(F.count("*"), F.mode(F.size("x"))).first()
    if not count:
        return vectors.select(F.col(key), F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.lit(True).alias("kept"))
    width, tables = plan(count, least)
    sample = classes.where((F.size("x") == dim) & (F.pmod(F.xxhash64("x"), F.lit(1 << 30)) < int(min(1.0, most_sample / count) * (1 << 30)))).select("x").toArrow().column(0).combine_chunks().values.to_numpy().astype(float).reshape(-1, dim)
    norms = np.linalg.norm(sample, axis=1, keepdims=True)
    mean, projection = learn(sample / norms if len(sample) else np.eye(dim), tables * width)
    held = spark.sparkContext.broadcast((mean, projection))
    weights = 1 << np.arange(width)

    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def chunks(x: np.ndarray) -> np.ndarray:
        """One row per vector of one length: its chunk in each table."""
        mean, projection = held.value if x.shape[1] == dim else (0.0, directions(x.shape[1], tables * width))
        return ((unit(x) - mean) @ projection >= 0).reshape(len(x), tables, width) @ weights

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                x, length = batch.column("x"), np.diff(batch.column("x").offsets.to_numpy())
                c = np.zeros((batch.num_rows, tables), np.int64)
                for d in np.unique(length).tolist():
                    own = np.flatnonzero(length == d)
                    c[own] = chunks(x.take(pa.array(own)).flatten().to_numpy().astype(float).reshape(-1, d))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, c.size + 1, tables, dtype=np.int32)), pa.array(c.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("label"), batch.column("dim"), flat], names=["h", "label", "dim", "chunks"])

    seen = classes.select(F.col("class.h").alias("h"), "label", F.size("x").cast("long").alias("dim"), "x")
    coded = materialise(seen.mapInArrow(code, "h long, label long, dim long, chunks array<long>"), "vector-codes")
    by = ["label", "dim", "table", "chunk"]
    entries = coded.select("h", "label", "dim", F.posexplode("chunks").alias("table", "chunk"))
    sizes = materialise(entries.groupBy(*by).agg(F.count("*").alias("size")).where("size > 1"), "vector-sizes")
    members = entries.join(sizes, by).withColumn("tiles", F.ceil(F.col("size") / tile).cast("int"))
    mine = F.when(F.col("tiles") == 1, F.lit(0)).otherwise(F.pmod(F.xxhash64("h", "table"), F.col("tiles")).cast("int"))
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, "mine").alias("lo"), F.greatest(t, "mine").alias("hi")))).alias("pair")
    blocks = members.withColumn("mine", mine).select("h", *by, "mine", pairs)
    blocks = materialise(blocks.select("h", "label", "dim", F.col("table").cast("long").alias("table"), "chunk", F.col("pair.lo").cast("long").alias("pair_lo"), F.col("pair.hi").cast("long").alias("pair_hi"), "mine"), "vector-blocks")
    own = classes.select(F.col("class.h").alias("h"), "n", "x").join(coded.select("h", "chunks"), "h")
    by = ["label", "dim", "table", "chunk", "pair_lo", "pair_hi"]
    flat = blocks.join(own, "h")

    def solve(rows: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
        """Links of whole blocks, rows ``bounds[i]`` to ``bounds[i + 1]`` each; then a spanning forest of theirs."""
        column = lambda name: rows.column(name).to_numpy(zero_copy_only=False)
        c = rows.column("chunks").flatten().to_numpy().reshape(-1, tables)
        table, lo, hi, mine, n, h, dims = (column(name) for name in ("table", "pair_lo", "pair_hi", "mine", "n", "h", "dim"))
        found_a, found_b, count = [], [], np.zeros(len(h), np.int64)
        flat_x, first = rows.column("x").flatten().to_numpy(), np.concatenate([[0], np.cumsum(dims)])
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            x = unit(flat_x[first[i] : first[j]].astype(float).reshape(-1, dims[i]))
            for at in range(0, j - i, 256):  # pairs of so many rows at a time
                near = x[at : at + 256] @ x.T >= least
                if lo[i] != hi[i]:
                    side = mine[i:j] == lo[i]
                    near &= side[at : at + 256, None] != side[None, :]
                a, b = np.nonzero(near)
                a, b = a[a + at != b] + at + i, b[a + at != b] + i
                if table[i] and len(a):  # a pair that shares an earlier table is counted there
                    fresh = ~(c[a, : table[i]] == c[b, : table[i]]).any(axis=1)
                    a, b = a[fresh], b[fresh]
                if len(a):
                    np.add.at(count, a, n[b])
                    a, b = stars(a, b) if j - i > 64 else (a, b)
                    found_a.append(a)
                    found_b.append(b)
        a, b = np.concatenate([np.zeros(0, np.int64), *found_a]), np.concatenate([np.zeros(0, np.int64), *found_b])
        some = np.flatnonzero(count)
        node, root = stars(h[a], h[b])
        none, empty = pa.nulls(len(node), pa.int64()), pa.nulls(len(some), pa.int64())
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(h[some]), none]), pa.concat_arrays([pa.array(count[some]), none]), pa.concat_arrays([empty, pa.array(node)]), pa.concat_arrays([empty, pa.array(root)])], names=["h", "links", "node", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in by], axis=1)
            cut = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1])
            held = batch.slice(int(cut[-1]))  # the last block may go on
            if len(cut) > 1:
                yield solve(batch.slice(0, int(cut[-1])), cut)
        if held is not None:
            yield solve(held, np.array([0, held.num_rows]))

    met = materialise(flat.select(*by, "h", "mine", "n", "x", "chunks").repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "h long, links long, node long, root long"), "vector-links")
    totals = met.where("h is not null").groupBy("h").agg(F.sum("links").alias("links"))
    parts = connected(met.where("node is not null").select("node", "root"), "node", "root")
    known = classes.select(F.col("class.h").alias("h"), "class", "rep", "n").join(totals, "h", "left").join(parts, F.col("h") == F.col("node"), "left").select("class", "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "h").alias("component"))
    known = materialise(known, "vector-known")
    least_key = known.groupBy("component").agg(F.min("rep").alias("component_id"))
    known = with_unique(known, least_key, ["component"])
    out = with_unique(rows.select("key", "class"), known.select("class", "n_links", "component_id"), ["class"])
    drop_materialised(coded, sizes, blocks, met)
    return out.select(F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "key").alias("component_id"), (F.col("key") == F.coalesce("component_id", "key")).alias("kept"))
