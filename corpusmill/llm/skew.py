"""Joins in which a few keys hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import materialise

#: Rows of a lookup that are broadcast as they are.
FEW = 50_000


def heavy_keys(rows: DataFrame, on: list[str], total: int, share: int, least: int, sampled: int = 500_000) -> DataFrame:
    """Keys with about one in ``share`` of all rows or more, and ``least`` rows or more: fewer than twice ``share``. They are
    looked for in about ``sampled`` rows at most, dealt by hash: which keys are found bears on speed alone."""
    part = min(1.0, sampled / max(total, 1))
    some = rows if part == 1 else rows.where(F.pmod(F.xxhash64(*rows.columns, F.lit(3)), F.lit(1 << 30)) < int(part * (1 << 30)))
    limit = max(least if part == 1 else 32, part * total / share)
    return some.groupBy(*on).agg(F.count("*").alias("__n")).where(F.col("__n") > limit).select(*on)


def with_unique(rows: DataFrame, lookup: DataFrame, on: list[str], share: int = 2000, least: int = 256) -> DataFrame:
    """``rows`` with the other columns of ``lookup``, which holds a key at most once (a left join).

    A lookup of at most ``FEW`` rows is broadcast, and nothing is shuffled. Of larger ones, keys with more than about one in ``share`` of all rows, so few of them, get theirs by a broadcast of that bounded number
    of rows; their rows are dealt by a hash of the whole row. All others meet by key. Null keys find nothing.
    """
    names = [c for c in lookup.columns if c not in on]
    lookup = materialise(lookup, "lookup")
    if lookup.count() <= FEW:
        return rows.join(F.broadcast(lookup.select(*on, *names)), on, "left").select(*rows.columns, *names)
    heavy = heavy_keys(rows, on, rows.count(), share, least)
    hot = lookup.join(F.broadcast(heavy), on, "left_semi").select(*on, F.struct(*names).alias("__hot"))
    # null keys, too, would all meet in one task
    apart = F.col("__hot").isNotNull() | F.greatest(*(F.col(c).isNull() for c in on), F.lit(False))
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("__at", F.when(apart, F.xxhash64(*rows.columns)).otherwise(F.xxhash64(*on)))
    other = lookup.select(F.xxhash64(*on).alias("__at"), *(F.col(c).alias(f"__{c}") for c in on), F.struct(*names).alias("__cold"))
    same = F.lit(True)
    for c in on:
        same &= F.col(c) == F.col(f"__{c}")
    joined = dealt.join(other.withColumnRenamed("__at", "__where"), (F.col("__at") == F.col("__where")) & same, "left")
    held = F.coalesce("__hot", "__cold")
    return joined.select(*rows.columns, *(held[c].alias(c) for c in names))
