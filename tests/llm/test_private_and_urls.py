"""Personal data, URL filters, fingerprints: against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest

pytest.importorskip("corpusmill.llm")
pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

import oracle  # noqa: E402
from corpusmill.llm import fingerprint, oracles, pii, queries, url_filter  # noqa: E402

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind != "ip" or max(map(int, m.group().split("."))) <= 255, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def brute_ids(texts, rounds=3, least=0.6, support=5):
    """(values that patterns vouch for, id spans of each text): the bootstrapping in plain Python."""
    cut = re.compile(r"[\s\"'`()\[\]{}<>]+|(?<=[=:])|(?<=[^\s\"'`()\[\]{}<>=:])(?=[=:])", re.ASCII)
    edges, base_values, totals, spans = Counter(), set(), Counter(), []
    for text in texts:
        text = text or ""
        base = base_spans(text)
        runs = [m for m in re.finditer(r"[A-Za-z0-9_-]+", text) if len(m.group()) >= 5 and re.search("[0-9]", m.group()) and m.group()[0] not in "_-" and m.group()[-1] not in "_-"]
        ids = [(m.start(), m.end()) for m in runs if not any(a < m.end() and m.start() < z for _, a, z in base)]
        spans.append([(text[a:z], a, z) for a, z in ids])
        base_values |= {text[a:z] for _, a, z in base}
        for a, z in [(a, z) for _, a, z in base] + ids:
            before = text[max(0, a - 200) : a]
            t = cut.split(before.lower())
            if len(t) >= (3 if len(before) < 200 else 4) and t[-1] == "" and t[-2] and t[-3]:
                edges[(t[-3], t[-2]), text[a:z]] += 1
        t = cut.split(text.lower())
        totals.update(zip(t, t[1:]))

    def secret(v):
        v = re.sub("[_-]", "", v) if len(v) >= 20 else ""
        return sum(x.isdigit() != y.isdigit() for x, y in zip(v, v[1:])) >= 6

    seeds = {v: 1.0 for _, v in edges if v in base_values or secret(v)}
    instances, accepted = seeds, {}
    for _ in range(rounds):
        hits, seen = Counter(), Counter()
        for (p, v), n in edges.items():
            if v in instances:
                hits[p] += n * instances[v]
                seen[p] += 1
        trusted = {p: min(1.0, hits[p] / totals[p]) for p in seen if seen[p] >= support and hits[p] / totals[p] >= least}
        doubt = {}
        for p, v in edges:
            if v not in base_values and p in trusted:
                doubt[v] = doubt.get(v, 1.0) * max(1 - trusted[p], 1e-6)
        accepted = {v: 1 - d for v, d in doubt.items() if 1 - d >= least}
        instances = seeds | {v: max(x, seeds.get(v, 0)) for v, x in accepted.items()}
    return set(accepted), [[(a, z) for v, a, z in s if v in accepted] for s in spans]


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    rng = random.Random(3)
    alphabet = list("  \naB@@..--++0123456789()%_é🤗")
    odd = [None, "", " ", "a@b.c+d@e.f@g.h", "1.2.3.4.5.6.7.8", "9" * 30000, "+1" + "2" * 20000, "a" * 50000, "1 2-3 4" * 3000, "4111111111111111", "x 4111 1111 1111 1111 y", "+1 (555) 010-9999.", "0255.1.2.3 256.1.1.1", "1.2.3.4" * 500, "a.b@c" * 2000]
    made = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(1500)]
    seeds = [f"filler {i} my account number {rng.choice([f'a{i}@b.com', f'10.0.0.{i % 250}', f'+1 555 010 {i:04d}'])} end" for i in range(60)]
    new = [f"and my account number QX-{i:06d} end" for i in range(10)] + ["some order QZ-000001 is clean"]
    new += [f'x token = "{hashlib.sha1(b"%d" % i).hexdigest()}" y' for i in range(6)] + ['a TOKEN="shorter9" b', "a token = [another-1x", "see 10.0.0.1, my account number 10.0.0.2, QX-000003,my account number QY-000001"]
    new += ["w " * 150 + "my account number QY-000002", "my " + "account" * 40 + " number QZ-000002", "my account number" + " " * 250 + "QZ-000003"]
    return odd + made + seeds + new + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]


def test_personal_data(spark, texts, tmp_path):
    spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, key string").repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.doc_id: r for r in queries.op3_pii(spark, str(tmp_path)).collect()}
    assert len(rows) == len(texts)
    accepted, ids = brute_ids(texts)
    assert {f"QX-{i:06d}" for i in range(10)} | {"shorter9", "another-1x", "QY-000001", "QY-000002"} <= accepted and not {"QZ-000001", "QZ-000002"} & accepted
    for i, text in enumerate(texts):
        spans = base_spans(text or "")
        joined, count = ",".join(f"{k}:{a}:{z}" for k, a, z in spans), Counter(k for k, _, _ in spans)
        r = rows[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in BASE)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)
        assert r.spans == ",".join([*filter(None, [joined]), *(f"id:{a}:{z}" for a, z in ids[i])])
        assert (r.n_id, r.n_spans) == (len(ids[i]), len(ids[i]) + len(spans))


def test_secrets_of_the_tables(spark):
    found = {r.doc_id: r for r in queries.op3_pii(spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    secrets = {r.doc_id for r in docs if re.search(r'(?i)token = "[0-9a-f]{40}"', r.text or "")}
    assert len(secrets) > 5 and {i for i, r in found.items() if r.n_id} == secrets


def test_personal_data_of_an_empty_table_and_clashing_names(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op3_pii(spark, str(tmp_path)).collect() == []
    docs = spark.createDataFrame([(1, "a@b.cd", "x", "y", 3)], "doc_id long, text string, spans string, kind string, start int")
    with pytest.raises(ValueError, match="spans"):
        pii.attach(docs, pii.find(docs))
    kept = pii.attach(docs.drop("spans"), pii.find(docs)).first()
    assert (kept.kind, kept.start, len(kept.spans)) == ("y", 3, 1)


def test_repeated_rows_and_redaction(spark):
    text = "mail a@b.cd, 10.0.0.1 and +1 555 010 1234!"
    docs = spark.createDataFrame([(1, text), (1, text), (1, "clean"), (None, text), (2, None)], "doc_id long, text string")
    got = pii.attach(docs, pii.find(docs)).select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("t")).collect()
    assert Counter((r.doc_id, r.t) for r in got) == {(1, "mail <EMAIL>, <IP> and <PHONE>!"): 2, (None, "mail <EMAIL>, <IP> and <PHONE>!"): 1, (1, "clean"): 1, (2, None): 1}
    assert "Python" not in docs.select(pii.redact(F.col("text"), F.array().cast("array<struct<start:long,end:long,kind:string>>")).alias("x"))._jdf.queryExecution().toString()


def ids_found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {s.value for r in pii.find(docs).collect() for s in r.spans if s.kind == pii.FOUND}


def test_support_does_not_grow_with_the_corpus(spark):
    many = [" ".join(f"plain words {i * 1000 + j:06d}" for j in range(1000)) for i in range(30)]
    few = [f"my account number a{i}@b.com end" for i in range(8)] + [f"my account number QX-{i:06d} end" for i in range(3)]
    assert ids_found(spark, many + few) == {f"QX-{i:06d}" for i in range(3)}


def test_found_identifiers_bring_new_patterns(spark):
    seeded = [f"my account number a{i}@b.com end" for i in range(40)] + [f"my account number QX-{i:06d} end" for i in range(10)]
    hop = [f"the ticket holder QX-{i:06d} end" for i in range(10)] + [f"the ticket holder QY-{i:06d} end" for i in range(2)]
    assert ids_found(spark, seeded + hop) == {f"QX-{i:06d}" for i in range(10)} | {f"QY-{i:06d}" for i in range(2)}


def test_url_filter_equals_sql(spark, sf_dir):
    oracle.check(spark, sf_dir, queries.op9_url_filter, oracles.ORACLES["op9_url_filter"])


URLS = [None, "", "x", "http://a.net", "http://a.net/", "http://EXAMPLE.net/en/x?y#z", "http://example.net/en", "http://example.net/en/", "ftp://b.example.com/de/", "http://xexample.com/de/", "http://u:p@example.com/de/", "http://org/fr/x", "://a.org/fr/", "http://a.net?x/y", "http://a.net#/", "http://.net/", "http://a.net:80/", "http://É.net/É"]


def test_one_or_many_tries_and_brute_force_agree(spark):
    rng = random.Random(1)
    rules = [*queries.URL_RULES, url_filter.Rule("allow", "a.net", "/x"), url_filter.Rule("block", "a.net", "/x/y/"), url_filter.Rule("block", "", "/all/"), url_filter.Rule("allow", "b.a.net", ""), url_filter.Rule("block", "b.a.net", "")]
    urls = URLS + ["http://" + ".".join(rng.choices(["a", "b", "net", "example", "com", "org"], k=rng.randint(1, 4))) + rng.choice(["", "/"]) + "/".join(rng.choices(["en", "de", "fr", "x", "y", "all", "xx", ""], k=rng.randint(0, 4))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")

    def brute(url):
        host, path = url_filter.split_url(url)
        fits = [r for r in rules if (r.host == "" or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = min(fits, key=url_filter.rank, default=None)
        return host, path, best and best.text, best.action if best else "allow"

    wanted = {i: brute(u) for i, u in enumerate(urls)}
    for most in (64 << 20, 200, 0):  # one trie, a few, one for each rule
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, rules, most_rule_bytes=most).collect()}
        assert got == wanted
    assert len(url_filter.portions(rules, 0)) == len(rules) > len(url_filter.portions(rules, 200)) > len(url_filter.portions(rules, 1 << 20)) == 1


def test_url_filter_edges(spark, tmp_path):
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op9_url_filter(spark, str(tmp_path)).collect() == []
    long = "http://a.net/" + "x/" * 100_000
    pages = spark.createDataFrame([(1, "http://a.net/x", "k"), (1, "http://a.net/x", "k"), (None, long, None)], "page_id long, url string, rule string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, queries.URL_RULES).collect())
    assert got == {(1, "a.net", "/x", "net/", "block"): 2, (None, "a.net", long[12:], "net/", "block"): 1}
    assert {r.verdict for r in url_filter.judge(pages, []).collect()} == {"allow"}
    with pytest.raises(ValueError, match="rule"):
        url_filter.judge(pages, queries.URL_RULES, keep=("page_id", "rule"))


def fingerprint_case(spark, rows, path):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{path}/documents.parquet")
    return queries.op4_fingerprint(spark, str(path)).collect()


def test_fingerprints(spark, sf_dir):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = {r.doc_id: r for r in queries.op4_fingerprint(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    prints = {}
    for i, (key, text) in enumerate(docs):
        following, half = docs[(i + 1) % len(docs)][1], len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = rows[key]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert sum(r.near_edited > r.near_next for r in rows.values()) > 0.9 * len(rows)
    assert sum(r.near_edited for r in rows.values()) > 10 * sum(r.near_next for r in rows.values())


def test_fingerprint_edges(spark, tmp_path):
    rows = [(5, "hello world abc"), (9, None), (12, ""), (2, "x" * 101), (100, "hello world abc"), (10**12, "far away text"), (10**12 + 1, "far away text")]
    got = {r.doc_id: r for r in fingerprint_case(spark, rows, tmp_path)}
    assert len(got) == 7 and got[5].fingerprint == got[100].fingerprint and got[5].fingerprint != got[2].fingerprint
    assert got[9].near_next == 1 and got[9].n_chars == 0 and got[10**12].near_next == 1
    assert got[10**12 + 1].edited_sha256 == hashlib.sha256(("far away text"[:7] + "x" * 6).encode()).hexdigest()
    (tmp_path / "e").mkdir()
    assert fingerprint_case(spark, [], tmp_path / "e") == []


M64 = (1 << 64) - 1


def hash64(value, seed=42):
    """The engine's 64-bit hash of a string or an array of ints (one after another)."""
    import xxhash

    if isinstance(value, str):
        return xxhash.xxh64_intdigest(value.encode(), seed)
    for v in value:
        seed = xxhash.xxh64_intdigest((v & 0xFFFFFFFF).to_bytes(4, "little"), seed)
    return seed


def signed(x, bits):
    return x - (1 << bits) if x >> (bits - 1) else x


def hash32(*values):
    """The engine's 32-bit hash of ints."""
    mask, turn = 0xFFFFFFFF, lambda x, r: (x << r | x >> (32 - r)) & 0xFFFFFFFF
    h = 42
    for v in values:
        k = turn((v & mask) * 0xCC9E2D51 & mask, 15) * 0x1B873593 & mask
        h = (turn(h ^ k, 13) * 5 + 0xE6546B64) & mask
        h ^= 4
        h = (h ^ h >> 16) * 0x85EBCA6B & mask
        h = (h ^ h >> 13) * 0xC2B2AE35 & mask
        h ^= h >> 16
    return signed(h, 32)


def brute_fingerprints(texts):
    import regex

    ids_of = lambda t: {signed(hash64(w), 64) % (1 << fingerprint.BITS) for w in regex.split(r"[^\p{L}\p{N}]+", t.lower())}
    code = lambda ids: f"{signed(hash64(sorted(ids)), 64) % (1 << 24):06x}" if ids else "-"
    df = Counter(i for t in texts for i in ids_of(t))
    band = {i for i, n in df.items() if 0.002 * len(texts) <= n <= 0.2 * len(texts)}

    def one(text):
        ids = ids_of(text)
        own, out = ids & band, []
        for level, slots in enumerate(fingerprint.SLOTS):
            kept = {t for t in own if not level or hash32(t, 100 + level) % 4**level == 0}
            out += [code({t for t in kept if hash32(t, level) % slots == k}) for k in range(slots)]
        return [*out, "-" if own else code(ids)]

    return one


def test_fingerprints_against_plain_python(spark, tmp_path):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 80))) for _ in range(60)] + ["only, rare;words", "", "Ünï 12 w1 W1"]
    keys = [*range(58), -(2**63), 2**63 - 1, 10**15, 10**15 + 1, -5]
    got = {r.doc_id: r for r in fingerprint_case(spark, list(zip(keys, texts)), tmp_path)}
    one, order = brute_fingerprints(texts), sorted(zip(keys, texts))
    prints = {k: one(t) for k, t in order}
    for i, (key, text) in enumerate(order):
        following, half = order[(i + 1) % len(order)], len(text) // 2
        edited = one(text[: len(text) - half] + following[1][:half])
        assert got[key].fingerprint == "".join(prints[key]) and got[key].edited_fingerprint == "".join(edited)
        for other, near in ((edited, got[key].near_edited), (prints[following[0]], got[key].near_next)):
            levels = [sum(fingerprint.SLOTS[:n]) for n in reversed(range(len(fingerprint.SLOTS)))]
            pairs = [[x == y for x, y in zip(prints[key][n:], other[n:]) if (x, y) != ("-", "-")] for n in [*levels, 0]]
            best = next((p for p in pairs[:-1] if len(p) >= fingerprint.ENOUGH), pairs[-1])
            assert abs(near - (sum(best) / len(best) if best else 1)) < 1e-9


def test_ranges_do_not_depend_on_how_ids_are_spread(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "cast(id AS string) AS text").unionByName(spark.createDataFrame([(10**15, "far"), (None, "none"), (7, "again")], "doc_id long, text string"))
    sizes = [r["count"] for r in fingerprint.with_next(rows).where("not guest").groupBy("part").count().collect()]
    assert sum(sizes) == 20_003 and len(sizes) > 100 and max(sizes) < 20 * fingerprint.LEAST_ROWS


def test_likeness(spark):
    one = spark.range(1)
    n = sum(fingerprint.SLOTS) + 1
    a, b = F.array(*[F.lit(i) for i in range(n)]), F.array(*[F.lit(i if i % 2 else -i) for i in range(n)])
    row = one.select(fingerprint.likeness(a, a).alias("x"), fingerprint.likeness(a, b).alias("y"), fingerprint.likeness(F.array_repeat(F.lit(None).cast("int"), n), F.array_repeat(F.lit(None).cast("int"), n)).alias("z")).first()
    assert row.x == 1 and 0.4 < row.y < 0.6 and row.z == 1
