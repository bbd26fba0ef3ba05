"""Connected components of large link tables.

Each round points both ends of a link to the smallest neighbour that either has; trees collapse to stars in a few rounds.
A round is one map-side combined minimum and two joins; the few nodes that hold a large share of the links (a bounded number)
get their minimum by a broadcast, so no task gathers a root's links. Before a round's links are shuffled, each task contracts its own
to a spanning forest of stars, so what moves is bounded by the nodes a task has seen. Rounds are written to the shared folder:
neither lineage nor the loss of executors grows with them. Nothing reaches the driver but two numbers a round.

As soon as no more than ``FEW`` links are left, whatever the size of the corpus, one task makes all of them stars (8 MB of links):
a round costs several shuffles, which many small partitions make slow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.skew import heavy_keys
from corpusmill.session import drop_materialised, materialise, share_code


#: Nodes with more than one in so many ends of links are heavy.
SHARE = 1000
#: So many links one task takes.
FEW = 500_000


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest position in the component of each of n positions, linked by pairs (a, b)."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, root[a], root[b])
        np.minimum.at(low, root[b], root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node of its component), without the smallest ones themselves."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    root = nodes[local_roots(len(nodes), at[: len(u)], at[len(u) :])]
    moved = root != nodes
    return nodes[moved], root[moved]


def contract(links: DataFrame, most: int = 500_000) -> DataFrame:
    """Links (u, v) with the same components, contracted per task in portions of at most ``most``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
            if sum(len(u) for u, _ in held) > most:
                held = [stars(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))]
                if len(held[0][0]) > most // 2:
                    u, v = held.pop()
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        if held:
            u, v = stars(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    share_code(links.sparkSession)
    return links.mapInArrow(run, "u long, v long")


def mark_of(links: DataFrame) -> tuple:
    """Two numbers that tell one state of the links from another."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _attach(links: DataFrame, on: str, name: str, least: DataFrame, heavy: list[int]) -> DataFrame:
    """``links`` with the minimum of the node ``on``. Heavy nodes' minima are broadcast; their links are dealt by both ends."""
    if not heavy:
        return links.join(least.select(F.col("u").alias(on), F.col("m").alias(name)), on)
    hot = least.where(F.col("u").isin(heavy)).select(F.col("u").alias(on), F.col("m").alias("hot"))
    dealt = links.join(F.broadcast(hot), on, "left").withColumn("at", F.when(F.col("hot").isNull(), F.col(on)).otherwise(F.xxhash64("u", "v")))
    found = dealt.join(least.select(F.col("u").alias("at"), F.col("m").alias("cold")), "at", "left")
    return found.withColumn(name, F.coalesce("hot", "cold")).drop("at", "hot", "cold")


def connected(links: DataFrame, a: str, b: str, few: int | None = None) -> DataFrame:
    """(node, component) for every node of ``links`` that has a link to another; component: the smallest node reachable.
    The last ``few`` (``FEW``) links are left to one task."""
    few = FEW if few is None else few
    ends = links.select(F.greatest(F.col(a), F.col(b)).cast("long").alias("u"), F.least(F.col(a), F.col(b)).cast("long").alias("v")).where("u <> v")
    now = materialise(contract(ends), "links")
    mark = mark_of(now)
    if mark[0] > few:
        now, last = materialise(now.distinct(), "links"), now
        mark = mark_of(now)
        drop_materialised(last)
    while mark[0] > few:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        heavy = [r.u for r in heavy_keys(both, ["u"], 2 * mark[0], SHARE, 256).collect()]  # fewer than 2 * SHARE
        ends = _attach(_attach(now, "u", "mu", least, heavy), "v", "mv", least, heavy)
        lowest = F.least("mu", "mv")
        pairs = ends.select(F.explode(F.array(F.struct(F.col("u"), lowest.alias("v")), F.struct(F.col("v").alias("u"), lowest.alias("v")))).alias("l")).select("l.u", "l.v").where("u <> v")
        after = materialise(contract(pairs).distinct(), "links")
        mark, last = mark_of(after), mark
        drop_materialised(now)
        now = after
        if mark == last:
            break
    else:
        if mark[0]:
            after = materialise(contract(now.coalesce(1), max(few, 1)), "links")
            drop_materialised(now)
            now = after
    return now.unionByName(now.select(F.col("v").alias("u"), "v").distinct()).select(F.col("u").alias("node"), F.col("v").alias("component"))
