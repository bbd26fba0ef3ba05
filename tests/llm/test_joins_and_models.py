"""Near-duplicate joins against brute force, models by held-out accuracy, components, and the pipeline."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("corpusmill.llm")
pytest.importorskip("public_tokenizers")

from corpusmill.llm import components, lang_id, near_vectors, quality, queries, shingle_join, skew  # noqa: E402
from corpusmill.session import materialise  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def word_sets(rows, k):
    out = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append({tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def brute_join(rows, k, num, den):
    sets, inverse, groups = word_sets(rows, k), defaultdict(list), Sets(len(rows))
    for i, x in enumerate(sets):
        for t in x:
            inverse[t].append(i)
    for i, x in enumerate(sets):
        for j, n in Counter(j for t in x for j in inverse[t] if j < i).items():
            if den * n >= num * (len(x) + len(sets[j]) - n):
                groups.join(i, j)
    low = {}
    for i, (key, _) in enumerate(rows):
        low[groups.root(i)] = min(low.get(groups.root(i), key), key)
    return sorted((key, len(sets[i]), low[groups.root(i)]) for i, (key, _) in enumerate(rows))


@pytest.fixture(scope="module")
def hard_rows():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A  B"), (6, "a"), (7, "a b c"), (8, "a b c")]
    base = [rng.choice(words) for _ in range(150)]
    for i in range(400):  # one large group of near copies
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        rows.append((100 + i, " ".join(copy)))
    chain = [rng.choice(words) for _ in range(300)]
    for i in range(350):  # a chain whose ends have nothing in common
        for _ in range(2):
            chain[rng.randrange(300)] = rng.choice(words)
        rows.append((2000 + i, " ".join(chain)))
    passage = " ".join(rng.choice(words) for _ in range(60))
    for i in range(300):  # a passage that many share
        rows.append((4000 + i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))) + " " + passage))
    return rows


@pytest.mark.parametrize(("k", "num", "tile"), [(3, 90, 100), (5, 80, 100), (3, 90, shingle_join.TILE)])
def test_shingle_join(spark, hard_rows, sf_dir, monkeypatch, k, num, tile):
    monkeypatch.setattr(shingle_join, "TILE", tile)
    real = [(10_000 + r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = hard_rows + real
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n long").repartition(4)
    assert sorted(map(tuple, shingle_join.link(df, k, num, 100).collect())) == brute_join(rows, k, num, 100)


@pytest.mark.parametrize("k", [1, 2, 3, 7])
def test_shingle_join_small(spark, k):
    rng = random.Random(k)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 9)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, shingle_join.link(df, k, 60, 100).collect())) == brute_join(rows, k, 60, 100)


def test_shingle_join_ends_when_all_is_one_component(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "TILE", 40)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in shingle_join.link(df, 5, 80, 100).collect()} == {0}


def rows_joined_by_class(spark, run):
    """What ``run`` returns, and the rows that inner joins of classes made meanwhile."""
    store = spark._jsparkSession.sharedState().statusStore()
    listed = lambda seq: [seq.apply(i) for i in range(seq.size())]
    spark.range(1).write.format("noop").mode("overwrite").save()
    before = max(e.executionId() for e in listed(store.executionsList()))
    result, made = run(), 0
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    for number in [e.executionId() for e in listed(store.executionsList()) if e.executionId() > before]:
        values = store.executionMetrics(number)
        for node in listed(store.planGraph(number).allNodes()):
            if re.search(r"Join \[class#\d+L\], \[class#\d+L\], Inner", node.desc()):
                counts = [values.get(m.accumulatorId()) for m in listed(node.metrics()) if m.name() == "number of output rows"]
                made += sum(int(c.get().replace(",", "")) for c in counts if c.isDefined())
    return result, made


@pytest.mark.parametrize("tile", [20, 90])
def test_large_blocks_do_not_join_the_sets_of_every_key(spark, monkeypatch, tile):
    """Relatives that share many keys but hardly link: no more rows than the way that is taken needs."""
    monkeypatch.setattr(shingle_join, "TILE", tile)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(100):
        copy = list(base)
        for at in rng.sample(range(150), 5 if i % 4 else 1):
            copy[at] = f"x{i}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, made = rows_joined_by_class(spark, lambda: sorted(map(tuple, shingle_join.link(df, 5, 80, 100).collect())))
    assert got == brute_join(rows, 5, 80, 100)
    # blocks, two rounds of tiles, and the pairs of tiles
    assert 0 < made <= 6 * 100 + 2 * 100 * 100 / tile


@pytest.mark.parametrize("keyed", [True, False])
def test_shingle_join_by_keys_and_by_tiles(spark, hard_rows, monkeypatch, keyed):
    """Both ways through large blocks find the same links, whichever is less."""
    monkeypatch.setattr(shingle_join, "TILE", 60)
    written, write = [], shingle_join.materialise

    def recorded(df, label="step"):
        if label == "shingle-costs":
            df = df.withColumn("keyed", shingle_join.F.lit(keyed))
        written.append(label)
        return write(df, label)

    monkeypatch.setattr(shingle_join, "materialise", recorded)
    df = spark.createDataFrame(hard_rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, shingle_join.link(df, 5, 80, 100).collect())) == brute_join(hard_rows, 5, 80, 100)
    assert ("shingle-grouped" in written) == keyed


def test_shingle_join_empty(spark):
    assert shingle_join.link(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(0)
    for num in (80, 90):
        for n in (5, 9, 17, 40, 130, 700):
            for _ in range(12):
                a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
                most = (100 - num) * 2 * n // (100 + num)
                gone = rng.integers(0, most + 1)
                b = np.unique(np.concatenate([a[gone // 2 :], rng.integers(0, 1 << 60, gone - gone // 2).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if both * 100 < num * (len(a) + len(b) - both) or np.array_equal(a, b):
                    continue
                sides = [shingle_join.keys(x, np.array([0, len(x)]), np.array([0]), num, 100) for x in (a, b)]
                both = set(sides[0][0].tolist()) & set(sides[1][0].tolist())
                count = [sum(x % 2 == parity for x in both) for parity in (0, 1)]
                assert any(count[p] and all(count[p] >= s[2][0, p] for s in sides) for p in (0, 1))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(2200)] + [(10_000 + i, 10_001 + i) for i in range(300)] + [(7, 7)] + [(20_000, 20_001 + i) for i in range(500)]
    groups = Sets(30_000)
    for a, b in pairs:
        groups.join(a, b)
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(pairs, "a long, b long").repartition(7), "a", "b").collect()}
    assert got == {x: groups.root(x) for x in linked}


def test_components_rounds_and_last_task(spark, monkeypatch):
    """A chain takes many rounds; few links are left to one task instead, with the same components."""
    pairs = [(i, i + 1) for i in range(300)] + [(1000 + i, 2000) for i in range(300)]
    links = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    wanted = {i: 0 for i in range(301)} | {x: 1000 for x in (*range(1000, 1300), 2000)}
    written = []
    monkeypatch.setattr(components, "materialise", lambda df, label: written.append(label) or materialise(df, label))
    got = [{r.node: r.component for r in components.connected(links, "a", "b", few).collect()} for few in (0, 100, 400)]
    assert got == [wanted] * 3
    written.clear()
    components.connected(links, "a", "b")
    assert len(written) <= 2
    assert components.connected(links.where("a < 0"), "a", "b").isEmpty()


def test_with_unique(spark, monkeypatch):
    rows = spark.createDataFrame([(7 if i % 3 else i, None if i % 50 == 0 else "x", i) for i in range(3000)], "k long, s string, i long").repartition(5)
    lookup = spark.createDataFrame([(i, "x", 2 * i) for i in range(0, 3000, 2)] + [(7, "x", -1), (9, None, -2)], "k long, s string, found long")
    got = []
    for few in (skew.FEW, 0):
        monkeypatch.setattr(skew, "FEW", few)
        joined = skew.with_unique(rows, lookup, ["k", "s"], share=100, least=8)
        got.append(({(r.k, r.s, r.i): r.found for r in joined.collect()}, "SortMergeJoin" in joined._jdf.queryExecution().toString()))
    assert got[0][0] == got[1][0] == {(r.k, r.s, r.i): None if r.s is None else -1 if r.k == 7 else 2 * r.k if r.k % 2 == 0 else None for r in rows.collect()}
    assert not got[0][1]  # a small lookup shuffles nothing


def brute_vectors(rows):
    good = [r[1] is not None and r[2] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1]) for r in rows]
    groups, links, labels = Sets(len(rows)), [0] * len(rows), defaultdict(list)
    for i, r in enumerate(rows):
        if good[i]:
            labels[r[2]].append(i)
    for at in labels.values():
        x = np.array([rows[i][1] for i in at], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= 0.98
        np.fill_diagonal(near, False)
        for a, b in zip(*np.nonzero(near), strict=True):
            links[at[a]] += 1
            groups.join(at[a], at[b])
    low = {}
    for i, r in enumerate(rows):
        low[groups.root(i)] = min(low.get(groups.root(i), r[0]), r[0])
    return sorted((r[0], links[i], low[groups.root(i)], r[0] == low[groups.root(i)]) for i, r in enumerate(rows))


def test_near_vectors(spark, tmp_path):
    rng = np.random.default_rng(1)
    base = rng.normal(size=64)
    rows = [(i, rng.normal(size=64).tolist(), int(i % 3)) for i in range(300)]
    rows += [(1000 + i, (base + rng.normal(size=64) * 0.05).tolist(), 5) for i in range(300)]
    rows += [(5000, None, 5), (5001, [0.0] * 64, 5), (5002, [float("nan")] * 64, 5), (5003, [None] * 64, 5), (5004, base.tolist(), None), (5006, (base * 3).tolist(), 5), (5007, [float("inf")] * 64, 5)]
    rows += [(6000 + i, base.tolist(), 5) for i in range(100)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert sorted(map(tuple, queries.op8_near_vectors(spark, str(tmp_path)).collect())) == brute_vectors([tuple(r) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").collect()])


def test_near_vectors_of_the_tables(spark):
    for sf in ("sf0.001", "sf0.1"):
        path = f"/root/testdata/{sf}"
        assert sorted(map(tuple, queries.op8_near_vectors(spark, path).collect())) == brute_vectors([tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").collect()])


def test_near_vectors_empty(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op8_near_vectors(spark, str(tmp_path)).collect() == []


def test_quality_held_out(spark):
    path = "/root/testdata/sf0.01"
    rows = queries.op5_quality(spark, path).join(spark.read.parquet(f"{path}/labels.parquet"), "doc_id").where("held_out").select("quality", "score", "predicted").toPandas()
    rank, good = rows.score.rank(), rows.quality == 1
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.97 and (rows.predicted == rows.quality).mean() > 0.95 and rows.score.between(0, 1).all()


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x " * 50_000), (3, "x " * 50_000), (4, "ok text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, none)).collect()
    assert len(got) == 5 and all(r.score == 0.5 for r in got)
    ones = spark.createDataFrame([(1, 1), (2, 1), (4, None)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.score(docs, quality.fit(docs, ones)).collect())
    assert quality.shape("ABcd12!!x") == "Aa9!!a" and quality.shape("ÄB") == "A"


def test_language_held_out(spark):
    path = "/root/testdata/sf0.01"
    rows = queries.op10_language_id(spark, path).join(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").select("lang", "lang_pred", "score").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.98 and rows.score.between(0, 1).all()


def test_language_edges(spark):
    train = spark.createDataFrame([(i, "the and of with " * 5, "en") for i in range(4)] + [(10 + i, "der die und mit " * 5, "de") for i in range(4)] + [(20, None, "en"), (21, "x", None)], "doc_id long, text string, lang string")
    model = lang_id.fit(train)
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "12 !!", 0), (4, "THE and", 0), (5, "und mit", 0), (5, "und mit", 0), (6, "日本", 0)], "doc_id long, text string, score int")
    got = Counter((r.doc_id, r.lang_pred) for r in lang_id.predict(docs, model).collect())
    assert all(got[i, "und"] == 1 for i in (1, 2, 3)) and got[4, "en"] == 1 and got[5, "de"] == 2 and sum(got.values()) == 7
    nothing = lang_id.fit(train.where("false"))
    assert {r.lang_pred for r in lang_id.predict(docs, nothing).collect()} == {"und"}


def test_filters_hold_all_languages():
    model = lang_id.Filters(["a", "b"], np.zeros((1 << 12, 1), np.uint64), np.zeros(2), (2,), 3)
    grams, _, _ = lang_id.word_grams(["hello", "world"], (2,))
    for at in lang_id.positions(grams, 1 << 12, 3):
        model.slices[at] |= np.uint64(3)
    assert (model.find(grams) == 3).all()
    assert (model.find(lang_id.word_grams(["zqxj"], (2,))[0]) == 0).all()


def test_more_languages_than_a_word_has_bits(spark):
    names = [f"l{i:03d}" for i in range(150)]
    rng = random.Random(8)
    own = {n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(12)] for n in names}
    rows = [(i * 10 + j, " ".join(rng.choices(own[n], k=40)), n) for i, n in enumerate(names) for j in range(4)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_id.fit(train)
    assert model.languages == names and model.slices.shape[1] == 3
    got = lang_id.predict(train, model, keep=("doc_id", "lang")).collect()
    assert len(got) == 600 and all(r.lang == r.lang_pred for r in got)
    with pytest.raises(ValueError, match="more than 100"):
        lang_id.fit(train, most_languages=100)
    assert lang_id.predict(train.where("false"), model).collect() == []
    with pytest.raises(ValueError, match="score"):
        lang_id.predict(train.selectExpr("doc_id", "text", "1 AS score"), model, keep=("doc_id", "score"))


def test_language_scores_against_plain_python(spark):
    """Shares of n-grams by sets in place of filters, which here make no false positives that count."""
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = docs.withColumn("held", queries.fold("doc_id", 4) == 2).collect()

    def grams(text):
        out = []
        for word in lang_id.regex.findall(r"\p{L}+", (text or "").lower()):
            w = f" {word} "
            out += [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if w[i : i + n] != " "]
        return out

    counts = defaultdict(Counter)
    for r in rows:
        if not r.held and r.lang is not None and r.text is not None:
            counts[r.lang].update(grams(r.text))
    known = {k: {g for g, n in c.items() if n >= 2 and n >= 2e-5 * c.total()} for k, c in counts.items()}
    got = {r.doc_id: r for r in queries.op10_language_id(spark, path).collect()}
    for r in rows:
        g = grams(r.text)
        if not g:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0)
            continue
        share = sorted(((sum(x in known[k] for x in g) / len(g), k) for k in known), key=lambda t: (-t[0], t[1]))
        if share[0][0] - share[1][0] > 0.01:
            assert got[r.doc_id].lang_pred == share[0][1]
        assert abs(got[r.doc_id].score - share[0][0] / (share[0][0] + share[1][0])) < 0.01


def test_quality_scores_against_plain_python(spark):
    """Pooling and the network, recomputed word by word."""
    import math
    import zlib

    rng = np.random.default_rng(0)
    vectors, dim = rng.normal(size=(64, 6)), 6
    texts = [None, "", "one two two Two!", "x " * 50, "Ä b\tc\n12 12"]
    model = quality.Model(vectors, rng.normal(size=dim + quality.EXTRAS), rng.uniform(1, 2, dim + quality.EXTRAS), rng.normal(size=(dim + quality.EXTRAS, 3)), rng.normal(size=3), rng.normal(size=3), 0.1, 1.7)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n = max(1, len(words))
        mean = sum((vectors[zlib.crc32(w.lower().encode()) % 64] + vectors[zlib.crc32(b"\0" + quality.shape(w).encode()) % 64] for w in words), np.zeros(dim)) / (2 * n)
        extras = [np.linalg.norm(mean), sum(a == b for a, b in zip(words, words[1:])) / n, len(set(words)) / n, math.log1p(len(words)), math.log1p(len((text or "").encode()) / n)]
        x = (np.concatenate([mean, extras]) - model.mean) / model.scale
        z = (np.tanh(x @ model.w1 + model.b1) @ model.w2 + model.b2) / model.temperature
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-5
    assert quality.score(docs.where("false"), model).collect() == []


def test_near_vectors_labels_lengths_and_shared_ids(spark):
    a, b, c = [1.0, 2.0], [1.0, 2.0001], [5.0, -1.0]
    rows = [(0, a, "x"), (1, b, "x"), (2, a, "y"), (3, b, None), (4, [1.0, 2.0, 3.0], "x"), (5, [1.0, 2.0, 3.001], "x"), (6, a, "x"), (6, c, "x"), (7, c, "x"), (None, [9.0, 9.0], "x"), (8, [0.0, -0.0, 1.0], "z"), (9, [-0.0, 0.0, 1.0], "z")]
    df = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<double>, label string, h string")
    got = sorted(((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in near_vectors.link(df).collect()), key=str)
    assert got == sorted([(0, 2, 0), (1, 2, 0), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 2, 0), (6, 1, 6), (7, 1, 6), (-1, 0, None), (8, 1, 8), (9, 1, 8)], key=str)
    number = spark.createDataFrame([(1, a, 0.25), (2, b, 0.5), (3, b, 0.25)], "vec_id long, embedding array<double>, label double")
    assert {r.vec_id: r.component_id for r in near_vectors.link(number).collect()} == {1: 1, 2: 2, 3: 1}


def test_tables_grow_so_that_near_pairs_meet():
    rng = np.random.default_rng(0)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    away = rng.normal(size=base.shape)
    away -= (away * base).sum(1, keepdims=True) * base
    other = 0.9801 * base + np.sqrt(1 - 0.9801**2) * away / np.linalg.norm(away, axis=1, keepdims=True)
    for log in (9, 16, 20, 24, 28, 31):
        width, tables = near_vectors.plan(1 << log, 0.98)
        mean, projection = near_vectors.learn(base, width * tables, rounds=5)
        for m, p in ((mean, projection), (0.0, near_vectors.directions(64, width * tables))):
            code = lambda x, m=m, p=p: ((x - m) @ p >= 0).reshape(len(x), tables, width)
            assert (code(base) == code(other)).all(axis=2).any(axis=1).mean() > 0.98


def test_joins_of_hot_keys(spark):
    from corpusmill.llm.skew import with_unique

    rows = [(1, i) for i in range(5000)] + [(2 + i % 300, i) for i in range(900)] + [(None, i) for i in range(700)]
    lookup = [(1, "hot"), *((2 + i, f"v{i}") for i in range(200))]
    got = with_unique(spark.createDataFrame(rows, "k long, i long").repartition(5), spark.createDataFrame(lookup, "k long, v string"), ["k"]).collect()
    assert Counter(map(tuple, got)) == Counter((k, i, dict(lookup).get(k)) for k, i in rows)


def test_shingle_join_of_shared_ids(spark):
    a, b = "a b c d e f g", "p q r s t u v"
    df = spark.createDataFrame([(0, a), (1, a), (1, b), (2, b), (None, a), (None, "x y z")], "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in shingle_join.link(df, 3, 90, 100).collect())
    assert got == {(0, 0): 1, (1, 0): 1, (1, 1): 1, (2, 1): 1, (None, 0): 1, (None, None): 1}


def test_pipeline(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    assert [n for n, _ in pipeline.STAGES] == ["quality", "language", "near_duplicates", "personal_data", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = pipeline.quality_stage(spark, docs, sf_dir).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = {r.doc_id for r in kept}
    assert sum(labels[i] == 1 for i in ids & set(labels)) >= 0.97 * sum(labels.values())
    rows = sorted((r.doc_id, r.text) for r in kept)
    wanted = {k for k, _, c in brute_join(rows, 5, 80, 100) if k == c}
    df = spark.createDataFrame([tuple(r) for r in kept], docs.schema)
    assert {r.doc_id for r in pipeline.duplicate_stage(spark, df, sf_dir).collect()} == wanted
    assert pipeline.language_stage(spark, df, sf_dir).count() == len(kept)
    odd = spark.createDataFrame([(1, None, "en", "s", None), (2, "", None, None, 0), (3, "mail a@b.cd", "en", "s", 11), (3, "mail a@b.cd", "en", "s", 11)], docs.schema)
    clean = pipeline.private_stage(spark, odd, sf_dir).collect()
    assert Counter(r.text for r in clean) == {None: 1, "": 1, "mail <EMAIL>": 2} and {r.n_chars for r in clean} == {None, 0, 12}
    assert pipeline.duplicate_stage(spark, odd, sf_dir).count() == 3
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns
    assert pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] > 0


def test_pipeline_stages_on_odd_rows(spark, sf_dir):
    """Null, empty and very long texts in the stages that judge or pack them; packing against the tokenizer itself."""
    import struct

    import public_tokenizers
    from tokenizers import Tokenizer

    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    best = max((r.text or "" for r in docs.collect()), key=len)
    odd = spark.createDataFrame([(-1, None, "en", "s", None), (-2, "", None, None, 0), (None, best + " " + best, "en", "s", 1), (-3, "x" * 300_000, None, "s", 1)], docs.schema)
    both = docs.unionByName(odd)
    kept = [r.doc_id for r in pipeline.quality_stage(spark, both, sf_dir).collect()]
    assert Counter(kept) <= Counter(r.doc_id for r in both.collect())
    language = pipeline.language_stage(spark, both, sf_dir).select("doc_id", "text").collect()
    assert {(r.doc_id, r.text) for r in language if r.doc_id is None or r.doc_id < 0} == {(None, best + " " + best)}
    reference = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in pipeline.packing_stage(spark, both, sf_dir).collect():
        pieces[r.doc_id].append((r.start, struct.unpack(f"<{r.length}I", r.ids)))
    for r in both.collect():
        assert [x for _, p in sorted(pieces[r.doc_id]) for x in p] == [*reference.encode(r.text or "", add_special_tokens=False).ids, 1]
    assert pipeline.packing_stage(spark, docs.limit(0), sf_dir).collect() == []


def test_language_stage_rejects_what_no_language_knows(spark, sf_dir):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(4)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(200))
    odd = ["Это простой текст на русском языке", "日本語の文章です 中文文章", noise, "12 !!", None]
    more = spark.createDataFrame([(-1 - i, t, "en", "s", 1) for i, t in enumerate(odd)], docs.schema)
    kept = pipeline.language_stage(spark, docs.unionByName(more), sf_dir).select("doc_id").collect()
    assert min(r.doc_id for r in kept) >= 0 and len(kept) == docs.count()


def test_duplicate_stage_keeps_rows_that_share_an_id_or_have_none(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    one, two = "a b c d e f g h", "q r s t u v w x"
    rows = [(None, "only here and without an id"), (None, None), (7, None), (7, one), (7, two), (9, one), (9, one), (None, two), (8, "words of an own kind here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = Counter((r.doc_id, r.text) for r in pipeline.duplicate_stage(spark, docs, "").collect())
    assert got == Counter([(None, rows[0][1]), (None, None), (7, None), (7, one), (7, two), (8, rows[8][1])])


@pytest.mark.parametrize("name", ["op7_shingle_join", "op8_near_vectors"])
def test_equals_sql(spark, sf_dir, name):
    import oracle
    from corpusmill.llm import oracles

    oracle.check(spark, sf_dir, queries.QUERIES[name], oracles.ORACLES[name])
