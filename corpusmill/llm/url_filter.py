"""URL filters: a trie over reversed host labels and path segments, broadcast, with longest-match precedence.

Tries hold at most ``most_rule_bytes`` of rules each; more rules make several, and the pages pass one trie after another, each
keeping the rule that precedes. No row is shuffled, and the answer does not depend on how the rules are divided.

Edge cases: a null url, or one without ``://``, has empty host and path and takes the default verdict; repeated urls
are judged alike, row by row; very long urls are read whole; of rules with equal text the blocking one counts, without rules
the default does; extra columns are carried only if named in ``keep``, and one that is named like an output is refused; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import words as W
from corpusmill.session import materialise, share_code

_LOWER = {i: i + 32 for i in range(65, 91)}


class Rule(NamedTuple):
    """``host`` and its subdomains, urls whose path starts with ``path``; action is allow or block."""

    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


def rank(rule: Rule) -> tuple:
    """Precedence: the lower one counts."""
    return -len(rule.text), rule.action != "block", rule.text


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) by plain text rules: no decoding, no default path."""
    start = -1 if url is None else url.find("://")
    if start < 0:
        return "", ""
    rest = url[start + 3 :]
    cut = min((i for i in (rest.find("?"), rest.find("#")) if i >= 0), default=len(rest))
    rest = rest[:cut]
    slash = rest.find("/")
    return (rest.translate(_LOWER), "") if slash < 0 else (rest[:slash].translate(_LOWER), rest[slash:])


class RuleTrie:
    """Nodes are ``[children by label, path root or None]``; path nodes are ``[children by segment, [(open segment, rule)]]``.

    A rule's last path segment is open: it matches any segment that starts with it. Precedence: the longest rule text
    (host and path); equally long ones: block before allow, then the lower text.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.root: list = [{}, None]
        for rule in rules:
            node = self.root
            for label in reversed(rule.host.split(".")) if rule.host else ():
                node = node[0].setdefault(label, [{}, None])
            if node[1] is None:
                node[1] = [{}, []]
            *closed, last = rule.path.split("/")
            at = node[1]
            for segment in closed:
                at = at[0].setdefault(segment, [{}, []])
            at[1].append((last, rule))

    def match(self, host: str, path: str) -> Rule | None:
        best, segments = None, path.split("/")
        node, labels = self.root, reversed(host.split(".")) if host else iter(())
        while node is not None:
            at, k = node[1], 0
            while at is not None:
                for last, rule in at[1]:
                    if segments[k].startswith(last) and (best is None or rank(rule) < rank(best)):
                        best = rule
                at = at[0].get(segments[k]) if k + 1 < len(segments) else None
                k += 1
            label = next(labels, None)
            node = None if label is None else node[0].get(label)
        return best


def portions(rules: list[Rule], most_rule_bytes: int) -> list[list[Rule]]:
    """The rules in runs of at most so many bytes (at least one rule each, and one run in any case)."""
    out, size = [[]], 0
    for rule in rules:
        own = len(rule.text.encode()) + 64
        if out[-1] and size + own > most_rule_bytes:
            out.append([])
            size = 0
        out[-1].append(rule)
        size += own
    return out


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", keep: tuple[str, ...] = ("page_id",), default: str = "allow", most_rule_bytes: int = 64 << 20) -> DataFrame:
    """``keep`` columns plus host, path, rule (text or null) and verdict (the longest rule's action, else ``default``)."""
    spark = pages.sparkSession
    share_code(spark)
    out = W.schema(pages.select(*keep), "host string, path string, rule string, verdict string")
    found = pages.select(*keep, F.col(url).alias("__url"), F.lit(None).cast("struct<action:string,host:string,path:string>").alias("__rule"))
    between = found.schema

    def tried(trie: RuleTrie, batch: pa.RecordBatch) -> tuple[list, list]:
        split = [split_url(u) for u in batch.column("__url").to_pylist()]
        known = [None if r is None else Rule(**r) for r in batch.column("__rule").to_pylist()]
        best = [min(filter(None, (k, trie.match(h, p))), key=rank, default=None) for k, (h, p) in zip(known, split, strict=True)]
        return split, best

    *before, last = [spark.sparkContext.broadcast(RuleTrie(part)) for part in portions(rules, most_rule_bytes)]
    kind = pa.struct([("action", pa.string()), ("host", pa.string()), ("path", pa.string())])
    for held in before:

        def some(batches: Iterator[pa.RecordBatch], held: Broadcast = held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                _, best = tried(held.value, batch)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([r and r._asdict() for r in best], kind)], names=batch.schema.names)

        found = materialise(found.mapInArrow(some, between), "rules")  # a worker holds one trie at a time

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split, best = tried(last.value, batch)
            made = ([h for h, _ in split], [p for _, p in split], [r and r.text for r in best], [r.action if r else default for r in best])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *(pa.array(x, pa.string()) for x in made)], names=out.names)

    return found.mapInArrow(run, out)
