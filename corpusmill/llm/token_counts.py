"""Token counts by field or section: offset-mapped attribution.

A document is encoded once as a whole. Token byte lengths give each token's character span (a token that holds part of a
character spans all of it); the spans are joined to the sections' intervals by binary search over their sorted starts.

Rule for a token that crosses a boundary (``rule``): ``most``: to the section that holds most of its characters, the
earlier one of equals; ``first``: to the section of its first character that lies in any. A token with no character in a
section counts as outside.

Edge cases: null and empty texts have no tokens (with line sections: one section with 0 tokens); empty sections count 0; what
a section has beyond its text counts 0, and so does a section without a start or an end; overlapping or unsorted sections are
an error; very long texts are encoded whole; repeated rows and null keys are counted row by row; an empty table gives an empty
result; other columns are carried only if named in ``keep``, and one that is named like an output is refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm import bpe
from corpusmill.llm import words as W
from corpusmill.session import share_code


def from_fields(docs: DataFrame, fields: list[str], separator: str = "\n", text: str = "text", sections: str = "sections") -> DataFrame:
    """Adds ``text``, the fields (null: empty) joined by ``separator``, and ``sections``, their [start, end) intervals."""
    parts = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    spans, at = [], F.lit(0)
    for p in parts:
        spans.append(F.struct(at.cast("long").alias("start"), (at + F.length(p)).cast("long").alias("end")))
        at = at + F.length(p) + len(separator)
    return docs.withColumns({text: F.concat_ws(separator, *parts), sections: F.array(*spans)})


def allocate(start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token or -1, whether it crosses a boundary) for sorted disjoint intervals [lo, hi)."""

    def at(pos: np.ndarray) -> np.ndarray:
        i = np.searchsorted(lo, pos, "right") - 1
        return np.where((i >= 0) & (pos < hi[np.maximum(i, 0)]), i, -1) if len(lo) else np.full(len(pos), -1)

    first, last = at(start), at(end - 1)
    crossing = (first != last) | ((first < 0) & (np.searchsorted(lo, start, "right") != np.searchsorted(lo, end - 1, "right")))
    out = first.copy()
    for t in np.flatnonzero(crossing).tolist():
        a, b = max(0, np.searchsorted(hi, start[t], "right")), np.searchsorted(lo, end[t], "left")
        inside = [(int(min(end[t], hi[i]) - max(start[t], lo[i])), -i) for i in range(a, b) if min(end[t], hi[i]) > max(start[t], lo[i])]
        out[t] = -1 if not inside else -max(inside)[1] if rule == "most" else -inside[0][1]
        crossing[t] = bool(inside)  # empty sections are no boundary
    return out, crossing


def attribute(docs: DataFrame, path: str, pattern: str, sections: str = "lines", rule: str = "most", text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus n_tokens, section_tokens (tokens of each section in order), outside_tokens and
    crossing_tokens. ``sections``: ``lines`` (each with the line feed that ends it) or the name of a column of
    array<struct<start long, end long>>, character intervals, ends exclusive."""
    if rule not in ("most", "first"):
        raise ValueError(f"unknown rule {rule!r}")
    share_code(docs.sparkSession)
    lines = sections == "lines"
    extra = [] if lines else [F.transform(F.col(sections), lambda s: F.array(s["start"].cast("long"), s["end"].cast("long"))).alias("__sections")]
    chosen = docs.select(*keep, *extra, F.col(text).alias("__text"))
    names = docs.select(*keep).columns
    out = W.schema(docs.select(*keep), "n_tokens long, section_tokens array<long>, outside_tokens long, crossing_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = bpe.codec(path, pattern)
        for batch in W.slices(batches, "__text"):
            texts = W.texts_of(batch, "__text")
            ids, bounds = own.encode(texts)
            raw = np.frombuffer(b"".join(t.encode() for t in texts.to_pylist()), np.uint8)
            lead = (raw & 0xC0) != 0x80
            char = np.cumsum(lead) - 1
            ends = np.cumsum(own.token_length[ids])
            begins = ends - own.token_length[ids]
            token_from, token_to = (char[begins], char[ends - 1] + 1) if len(ids) else (begins, ends)
            byte_of = np.concatenate([[0], ends])[bounds]
            base = np.concatenate([[0], np.cumsum(lead)])[byte_of]  # characters before each text, and in all
            if lines:
                breaks = char[raw == 10] + 1
                doc = np.searchsorted(base[1:], breaks - 1, "right")
                count = np.bincount(doc, minlength=len(texts)) + 1
                lo = np.sort(np.concatenate([base[:-1], breaks]), kind="stable")
                hi = np.concatenate([lo[1:], base[-1:]])
                # a text that ends with a line feed has an empty last section; equal starts keep their order
            else:
                spans = [s or [] for s in batch.column("__sections").to_pylist()]
                count = np.fromiter(map(len, spans), np.int64, len(spans))
                given = np.array([(0, 0) if None in (x or [None]) else x for s in spans for x in s], np.int64).reshape(-1, 2)
                used = given[:, 0] != given[:, 1]  # empty sections may stand anywhere
                owner = np.repeat(np.arange(len(spans)), count)[used]
                if (given[:, 0] > given[:, 1]).any() or ((owner[1:] == owner[:-1]) & (given[used][:-1, 1] > given[used][1:, 0])).any():
                    raise ValueError("sections overlap, or are not sorted")
                size = np.repeat(np.diff(base), count)[:, None]
                flat = np.clip(given, 0, size) + np.repeat(base[:-1], count)[:, None]
                flat[~used] = 0
                flat = np.maximum.accumulate(flat.ravel()).reshape(-1, 2) if len(flat) else flat  # empty ones at the end before
                lo, hi = flat[:, 0], flat[:, 1]
            section, crossing = allocate(token_from, token_to, lo, hi, rule)
            per = np.bincount(section[section >= 0], minlength=len(lo))[: len(lo)].astype(np.int64)
            cut = np.concatenate([[0], np.cumsum(count)])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(per)), pa.array(W.sums((section < 0).astype(np.int64), bounds)), pa.array(W.sums(crossing.astype(np.int64), bounds))],
                names=[f.name for f in out.fields],
            )

    return chosen.mapInArrow(run, out)
