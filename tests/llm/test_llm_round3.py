"""Ranked lexical search, source mixing and whitening against brute force."""

import collections
import math
import random
import re

import numpy as np
import pytest
from llm_cases import LONG, PASSAGE, TEXTS, documents, rows_of, words

from tessera.llm import lexical, mixing, whitening
from tessera.llm.shared import ship_package, written


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


# ranked lexical search


def found_terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k):
    bags = [(d, collections.Counter(found_terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_all, l_all = len(bags), sum(sum(b.values()) for _, b in bags)
    df = collections.Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for d, b in bags:
            m = 75 + (25 * sum(b.values()) * n_all) // l_all
            s = sum(math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m))
                    for t in found_terms(text) if t in b)
            if s > 0:
                scores.append((-s, d is None, d))
        scores.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def prose(seed, n, vocabulary=300):
    r = random.Random(seed)
    common = [f"w{int(r.paretovariate(0.7)) % vocabulary}" for _ in range(5000)]
    return [" ".join(r.choices(common, k=r.randint(1, 60))) for _ in range(n)]


ITEMS = [(1, PASSAGE), (2, "one two one"), (3, None), (4, ""), (5, "!?"), (6, "nowhere to be seen"), (None, "c b a"), (7, "É é t0x0 T1X1 t5x5"),
         (7, "another text"), (2, "one two one")]


@pytest.mark.parametrize("round_bytes", [1 << 20, 300])
def test_search_equals_brute_force(spark, monkeypatch, round_bytes):
    monkeypatch.setattr(lexical, "BATCH_DOCS", 40)
    docs = TEXTS + [(100 + i, t) for i, t in enumerate(prose(1, 300))] + [(50, "w1 w2 w3")] * 30  # ties and a third alike
    items = ITEMS + [(100 + i, t) for i, t in enumerate(prose(2, 30))]
    table = spark.createDataFrame([(i, t, 5, "r") for i, t in items], "item_id long, text string, rank int, doc_id string")
    got = rows_of(lexical.search(documents(spark, docs).repartition(3), table, k=5, round_bytes=round_bytes), "item_id", "rank", "doc_id", "score")
    assert got == ranked(docs, list(dict.fromkeys(items)), 5)


def test_search_prunes_without_losing(spark):
    docs = [(i, t) for i, t in enumerate(prose(3, 4000, 3000))]
    items = [(i, docs[i * 97][1]) for i in range(40)]
    vocab, bags = {}, []
    for _, t in items:
        bags.append(collections.Counter(vocab.setdefault(x, len(vocab)) for x in found_terms(t)))
    encoded = {t.encode(): n for t, n in vocab.items()}
    packed = written(lexical.index(documents(spark, docs).repartition(2), encoded, "doc_id", "text"), "t")
    n, total, df = lexical.corpus_figures(packed, len(vocab))
    weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * int(x) + 1))) for x in df])
    tree = lexical.QueryTree.of(bags, weight, n, total)
    shared = spark.sparkContext.broadcast((tree, weight))
    found = written(lexical._search(packed, shared, np.zeros(len(items), "int64"), 1), "t")
    scored = found.where("query = -1").agg({"score": "sum"}).first()[0]
    assert 0 < scored < len(items) * len(docs) / 2  # most pairs go with their nodes
    got = rows_of(lexical._ranked(found, 1), "query", "doc_id", "score")
    assert got == sorted(((q, d, s) for q, _, d, s in ranked(docs, items, 1)), key=str)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(documents(spark), none).count() == 0
    some = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(documents(spark, []), some).count() == 0


# mixing


def mixed(rows, weights=(3, 1, 2), share=1.5, most=2):
    """(id, size, source size, target) by resharing in a plain loop."""
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    order = sorted((s for s in size if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in size)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, rest = {}, share * sum(size.values())
    while True:
        left = [s for s in order if s not in target]
        level = rest / sum(w[s] for s in left)
        above = [s for s in left if level * w[s] > most * size[s]]
        if not above:
            target.update({s: level * w[s] for s in left})
            return [(d, len(words(t)), size[s], target[s]) for d, t, s in rows]
        for s in above:
            target[s] = most * size[s]
            rest -= target[s]


SOURCES = ["b", "a", None, "é", "z😀", "zﾟ", "a ", ""]


def mix_rows():
    r = random.Random(4)
    rows = [(d, t, SOURCES[i % 8]) for i, (d, t) in enumerate(TEXTS)]
    rows += [(200 + i, " ".join("x" for _ in range(r.randint(0, 90))), "hot") for i in range(200)] + [(7, "same text", "hot")] * 40
    return rows + [(500 + i, " \t " if i % 2 else None, "nothing") for i in range(4)]


def mix_table(spark, rows):
    return spark.createDataFrame([(d, t, s, 1, 2, "k") for d, t, s in rows], "doc_id long, text string, source string, size int, slot int, key string")


@pytest.mark.parametrize("block", [7, 256])
def test_mix_meets_its_targets(spark, block):
    rows = mix_rows()
    sized = written(mixing.sizes(mix_table(spark, rows).repartition(3)), "t")
    got = mixing.taken(sized, block_words=block).collect()
    assert sorted((r.doc_id, r["size"], r.source_size) for r in got if r.doc_id) == sorted(x[:3] for x in mixed(rows) if x[0])
    want = sorted((x[2], x[3]) for x in mixed(rows))
    assert np.allclose([x for x in sorted((r.source_size, r.target) for r in got)], want)
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = collections.defaultdict(int)
    for r in got:
        by[r.source, r.target] += r.taken
    assert all(n == math.floor(t) for (_, t), n in by.items())
    again = mixing.taken(sized.repartition(5), block_words=block).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_schedule_spreads_every_source_and_reads_back(spark):
    rows = mix_rows()
    docs = mix_table(spark, rows)
    pieces, per = mixing.mix(written(mixing.sizes(docs), "t"), block_words=16)
    pieces = written(pieces, "t")
    slots = {r.slot: r.s for r in pieces.where("slot is not null").collect()}
    n = len(slots)
    assert sorted(slots) == list(range(n))
    for s in set(slots.values()):
        at = [i for i in range(n) if slots[i] == s]
        share = len(at) / n
        assert all(abs(sum(1 for x in at if x < c) - share * c) <= 4 for c in range(0, n, 10))  # even over any beginning
    texts = {(d, len(words(t)), i): words(t) for i, (d, t, _) in enumerate(rows)}
    known = collections.defaultdict(list)
    for (d, size, _), w in texts.items():
        known[d, size].append(w)
    out = mixing.texts(docs, pieces).collect()
    assert len(out) == pieces.where("n_words > 0").count()
    assert all(any(w[r.start : r.start + r.n_words] == r.piece.split(" ") for w in known[r.doc_id, r["size"]]) for r in out)
    full = collections.Counter()
    for r in out:
        full[r.slot] += r.n_words
    assert max(full.values()) == 16 and sum(1 for v in full.values() if v < 16) <= 3 * len(set(slots.values()))


def test_mix_of_odd_tables(spark):
    assert mixing.taken(mixing.sizes(mix_table(spark, []))).count() == 0
    empty = mixing.taken(mixing.sizes(mix_table(spark, [(1, None, "a"), (None, "", None)])))
    assert rows_of(empty, "doc_id", "size", "source_size", "target", "taken") == [(1, 0, 0, 0.0, 0), (None, 0, 0, 0.0, 0)]
    one = mixing.taken(mixing.sizes(mix_table(spark, [(1, LONG, "a")]))).first()
    assert one.taken == 45_000 and one.target == 45_000.0


def test_mix_runs_no_python(spark):
    plan = mixing.taken(mixing.sizes(mix_table(spark, mix_rows())))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# whitening


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<double>, x int, n string")


def brute(rows, top=4):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(256 * c) for c in v] for _, v in good], dtype="int64")
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    e, c = np.linalg.eigh(np.cov(u.T.astype(float), bias=True))
    e, c = e[::-1], c[:, ::-1]
    return [i for i, _ in good], n, ((n * x - s) ** 2).sum(1), ((x - s / n) @ c[:, :top]) / np.sqrt(e[:top]), e[:top] / e.sum()


@pytest.mark.parametrize("shift", [0.0, 3e5])
def test_whitening_equals_brute_force(spark, shift):
    r = np.random.default_rng(5)
    base = r.standard_normal((400, 12)) @ np.diag(np.geomspace(4, 0.02, 12)) @ np.linalg.qr(r.standard_normal((12, 12)))[0] + shift
    rows = [(i, list(map(float, v))) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(200)] + [(4, rows[9][1]), (None, rows[8][1])]  # a third alike, an id again
    odd = [(2000, None), (2001, []), (2002, [1.0, None] + [0.0] * 10), (2003, [float("nan")] * 12), (2004, [float("inf")] * 12), (2005, [1.0, 2.0])]
    got = whitening.whitened_embeddings(vectors(spark, rows + odd).repartition(4)).collect()
    ids, n, dev, z, share = brute(rows)
    assert len(got) == 4 * len(rows) and {g.n for g in got} == {n}
    assert sorted((str(g.vec_id), g.deviation) for g in got if g.component == 1) == sorted((str(i), int(d)) for i, d in zip(ids, dev))
    by = {(g.vec_id, g.component): g for g in got if g.vec_id != 4}
    for c in range(4):
        mine = np.array([by[i, c + 1].whitened for i in ids if i != 4])
        want = np.array([z[k, c] for k, i in enumerate(ids) if i != 4])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-6
        assert abs(by[0, c + 1].explained / share[c] - 1) < 1e-8
    assert len({g.identity_error for g in got}) == 1 and got[0].identity_error < 1e-8


def test_factor_and_rotations():
    r = np.random.default_rng(6)
    for d, rank in ((1, 1), (5, 5), (8, 3), (33, 33)):
        b = r.standard_normal((d, rank)) * np.geomspace(1, 1e-5, rank)
        a = b @ b.T
        order, l = whitening.pivoted_cholesky(a)
        assert np.allclose(l @ l.T, a[np.ix_(order, order)], atol=1e-14)
        assert np.allclose(np.triu(l, 1), 0) and (d, rank) != (8, 3) or l.shape[1] <= d
        u = whitening.rotated(l)
        norm2 = np.sort((u * u).sum(0))[::-1]
        exact = np.sort(np.linalg.svd(b, compute_uv=False) ** 2)[::-1]
        assert np.allclose(norm2[:rank][:3], exact[:3], rtol=1e-10)
        v = u[:, (u * u).sum(0) > 1e-12]
        v = v / np.linalg.norm(v, axis=0)
        assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-10


def test_products_are_exact_beyond_doubles():
    y = np.array([[1 << 52, 3], [-(1 << 53), 1], [7, 1 << 51]])
    want = y.astype(object).T @ y.astype(object)
    assert (whitening._products(y) == want).all()


def test_whitening_of_odd_tables(spark):
    assert whitening.whitened_embeddings(vectors(spark, [])).count() == 0
    assert whitening.whitened_embeddings(vectors(spark, [(1, None), (2, [float("nan")])])).count() == 0
    assert whitening.whitened_embeddings(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # no variance
    got = whitening.whitened_embeddings(vectors(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])).collect()  # one direction
    assert sorted((g.vec_id, g.component, g.deviation, abs(round(g.whitened, 9)), round(g.explained, 9)) for g in got) == [(1, 1, 65536, 1.0, 1.0), (2, 1, 65536, 1.0, 1.0)]
    far = whitening.whitened_embeddings(vectors(spark, [(1, [1e300, 0.0]), (2, [-1e300, 0.5]), (3, [0.0, 0.25])])).collect()
    assert len(far) >= 3 and all(math.isfinite(g.whitened) and g.deviation is None or g.deviation >= 0 for g in far)
