"""Packing, byte-level BPE, token counts: against the tokenizers' own results over odd and real texts."""

import base64
import hashlib
import random
import struct
import zlib

import pytest

pytest.importorskip("corpusmill.llm")
P = pytest.importorskip("public_tokenizers")

from corpusmill.llm import bpe, packing, queries, token_counts  # noqa: E402

ALPHABET = list(" \n\tabcXYZ'sdtl.,!?0123éÀ​ \x85\x1c#日🤗İẞ̈")
ODD = [None, "", " ", "\n", "a\n", "\n\nb", "<|endoftext|> x", "a<|endoftext|>B<|EndOfText|> c <|startoftext|>", "İstanbul ẞ", "a" * 5000, "日本\n🤗🤗🤗 x", "don't we'll  x", "a  b   c \n d", "word!!! word%%% | x"]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rng = random.Random(3)
    made = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(800)]
    return ODD + made + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


@pytest.fixture(scope="module")
def folder(spark, texts, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("texts"))
    spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


def test_packing(spark, texts, folder):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = queries.op1_packing(spark, folder).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = reference.encode(text or "", add_special_tokens=False).ids + [1]
        at = 0
        for p in sorted(by[i], key=lambda r: r.start):
            assert (p.start, p.offset, p.doc_tokens) == (at, 0, len(ids))
            assert p.length & (p.length - 1) == 0 and p.length <= 2048 and 1 << p.bucket == p.length
            assert zlib.crc32(struct.pack(f"<{p.length}I", *ids[at : at + p.length])) == p.ids_crc32
            at += p.length
        assert at == len(ids)


@pytest.mark.parametrize("held", [100, 1 << 20])
def test_remembered_words(held):
    """Many small slices through one tokenizer, whose memory is emptied now and then or never."""
    import pyarrow as pa
    from tokenizers import Tokenizer

    own, reference, rng = packing.WordTokenizer(P.path("word_bpe_49k.json"), held), Tokenizer.from_file(P.path("word_bpe_49k.json")), random.Random(1)
    for _ in range(400):
        texts = [" ".join("".join(rng.choices("ab.,!", k=rng.randint(1, 3))) for _ in range(rng.randint(0, 5))) for _ in range(3)]
        ids, bounds = own.encode(pa.array(texts, pa.large_string()))
        for i, text in enumerate(texts):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == reference.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 2047, 2048, 2049, 5000, 8192])
def test_decompose(n):
    parts = packing.decompose(n, 2048)
    assert sum(parts) == n and parts == sorted(parts, reverse=True) and len(set(p for p in parts if p < 2048)) == len([p for p in parts if p < 2048])


def test_packing_repeated_rows_and_checks(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert len({r.sequence_id for r in packing.pack(docs, P.path("word_bpe_49k.json")).collect()}) == 4  # lengths 2 and 1, twice
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(docs, P.path("word_bpe_49k.json"), longest=100)


def test_byte_bpe(spark, texts, folder):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in queries.op2_byte_bpe(spark, folder).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        ids = reference.encode_ordinary(text or "")
        r = rows[i]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_multi_vocabulary_round_trip(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = bpe.encode(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert all(bytes(r.decoded).decode() == (texts[r.doc_id] or "") for r in rows)


def test_token_counts(spark, texts, folder):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    rows = {r.doc_id: r for r in queries.op6_token_counts(spark, folder).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        text = text or ""
        encoded, spans, at = reference.encode(text, add_special_tokens=False), [], 0
        for line in text.split("\n"):
            spans.append((at, at + len(line) + 1))
            at += len(line) + 1
        wanted, crossing = [0] * len(spans), 0
        for a, b in encoded.offsets:
            shared = [min(b, z) - max(a, y) for y, z in spans]
            wanted[max(range(len(spans)), key=lambda k: (shared[k], -k))] += 1
            crossing += sum(s > 0 for s in shared) > 1
        r = rows[i]
        assert (r.n_tokens, r.section_tokens, r.crossing_tokens, r.outside_tokens) == (len(encoded.ids), wanted, crossing, 0)


def test_token_counts_of_fields(spark):
    docs = spark.createDataFrame([(1, "one two", None, "three"), (2, "", "x", "")], "doc_id long, a string, b string, c string")
    rows = {r.doc_id: r for r in token_counts.attribute(token_counts.from_fields(docs, ["a", "b", "c"]), P.path("byte_bpe_50k.tiktoken"), P.PATTERN, sections="sections").collect()}
    assert rows[1].section_tokens == [2, 0, 1] and rows[1].outside_tokens == rows[1].n_tokens - 3
    assert rows[2].section_tokens == [0, 1, 0]
    bad = docs.selectExpr("doc_id", "a AS text", "array(named_struct('start', 3L, 'end', 5L), named_struct('start', 0L, 'end', 4L)) AS s")
    with pytest.raises(Exception, match="overlap"):
        token_counts.attribute(bad, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, sections="s").collect()
    with pytest.raises(ValueError, match="rule"):
        token_counts.attribute(docs, "", "", rule="none")


def test_token_rules(spark):
    docs = spark.createDataFrame([(1, "ab\n\n\ncd")], "doc_id long, text string").selectExpr("*", "array(named_struct('start', 0L, 'end', 3L), named_struct('start', 3L, 'end', 7L)) AS s")
    most, first = (token_counts.attribute(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, sections="s", rule=r).first().section_tokens for r in ("most", "first"))
    assert sum(most) == sum(first)


@pytest.mark.parametrize("rule", ["most", "first"])
def test_token_counts_of_any_sections(spark, texts, rule):
    """Sections that leave gaps, are empty, or reach beyond their text, against plain Python."""
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    reference.encode_special_tokens = True
    rng, rows = random.Random(9), [(0, "ab", [(0, 50)]), (1, "one two three four", [(0, 3)]), (2, None, [(0, 9), (9, 9), (12, 20)]), (3, "a b", None), (4, "a b", [(None, 2), (0, 1)]), (5, "a b", [(0, 3), (1, 1)])]
    for i, text in enumerate(texts[:300]):
        cuts = sorted(rng.choices(range(len(text or "") + 12), k=2 * rng.randint(0, 4)))
        rows.append((10 + i, text, list(zip(cuts[::2], cuts[1::2]))))
    docs = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<start:long,end:long>>").coalesce(1)
    got = {r.doc_id: r for r in token_counts.attribute(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, sections="s", rule=rule).collect()}
    for key, text, spans in rows:
        spans = [(0, 0) if None in x else x for x in spans or []]
        per, outside, crossing = [0] * len(spans), 0, 0
        encoded = reference.encode(text or "", add_special_tokens=False)
        for a, b in encoded.offsets:
            shared = [max(0, min(b, z) - max(a, y)) for y, z in spans]
            some = [k for k, n in enumerate(shared) if n]
            if some:
                per[max(some, key=lambda k: (shared[k], -k)) if rule == "most" else some[0]] += 1
                crossing += sum(shared) < b - a or len(some) > 1
            else:
                outside += 1
        r = got[key]
        assert (r.n_tokens, r.section_tokens, r.outside_tokens, r.crossing_tokens) == (len(encoded.ids), per, outside, crossing), (text, spans)


def test_packing_keys_and_clashing_names(spark):
    docs = spark.createDataFrame([(None, "a b", 7), (1, None, 8)], "doc_id long, text string, length int")
    assert sorted((r.doc_id is None, r.length) for r in packing.pack(docs, P.path("word_bpe_49k.json")).collect()) == [(False, 1), (True, 1), (True, 2)]
    with pytest.raises(ValueError, match="length"):
        packing.pack(docs, P.path("word_bpe_49k.json"), keep=("doc_id", "length"))


@pytest.mark.parametrize("name", ["op1_packing", "op2_byte_bpe", "op6_token_counts"])
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
