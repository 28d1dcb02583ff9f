"""Substring dedup, near-dedup, decontamination and embeddings against brute force."""

import itertools
import random

import corpus_pipeline
import numpy as np
import pytest
from llm_cases import LONG, PASSAGE, TEXTS, contaminated, documents, removed, rows_of, shingles, smallest_reachable
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from tessera.llm import decontaminate, embeddings, near_dedup, repeats
from tessera.llm.shared import component_labels, ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(1, 200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (6001, 6000), (6000, 6001)]
    got = dict(rows_of(component_labels(spark.createDataFrame(edges, "a long, b long"))))
    exp = {i: 1 for i in range(1, 201)} | {i: 1000 for i in range(1000, 1100)} | {6000: 6000, 6001: 6000}
    assert got == exp
    assert component_labels(spark.createDataFrame([], "a long, b long")).count() == 0


def test_repeats_equal_brute_force(spark):
    assert rows_of(repeats.remove_repeats(documents(spark))) == removed(TEXTS)
    r = random.Random(2)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randint(0, 120)))) for i in range(40)]
    rows += [(100 + i, "p q " + " ".join(PASSAGE.split()[i % 7 : 36 + i % 11]) + " r") for i in range(25)]
    assert rows_of(repeats.remove_repeats(documents(spark, rows), batch_bytes=500, bin_bytes=500)) == removed(rows)
    assert repeats.remove_repeats(documents(spark, [])).count() == 0
    kept = {x.doc_id: x.text for x in repeats.remove_repeats(documents(spark, rows), with_text=True).collect()}
    assert kept[0] == rows[0][1].strip() or removed(rows)


def test_repeats_do_not_depend_on_row_order(spark, monkeypatch):
    r = random.Random(5)
    shared = [" ".join(f"s{k}x{i}" for i in range(40)) for k in range(12)]
    rows = [(i, " ".join([f"o{i}x{j}" for j in range(r.randint(0, 90))] + [r.choice(shared), f"e{i}"] + [f"q{i}x{j}" for j in range(r.randint(0, 90))]))
            for i in range(150)]
    plain = PandasCogroupedOps.applyInPandas

    def mixed(self, func, schema):  # each pass over the batches sees its rows in an order of its own
        seed = len(schema)
        return plain(self, lambda key, docs, replies: func(key, docs.sample(frac=1, random_state=seed).reset_index(drop=True), replies), schema)

    monkeypatch.setattr(PandasCogroupedOps, "applyInPandas", mixed)
    assert rows_of(repeats.remove_repeats(documents(spark, rows))) == removed(rows)
    assert rows_of(repeats.remove_repeats(documents(spark))) == removed(TEXTS)


def near_rows():
    r = random.Random(4)
    base = [f"v{r.randint(0, 5000)}" for _ in range(120)]
    rows = list(TEXTS)
    for i in range(60):  # a family around one text, some beyond reach of each other
        w = list(base)
        for _ in range(r.randint(0, 6)):
            w[r.randrange(len(w))] = f"u{r.randint(0, 10**6)}"
        rows.append((1000 + i, " ".join(w)))
    chain = [f"c{i}" for i in range(100)]
    for i in range(25):  # each near the next, the ends far apart
        rows.append((2000 - i, " ".join(chain[i * 3 :] + [f"d{j}" for j in range(i * 3)])))
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    sets = [shingles(t) for _, t in rows]
    linked = {(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
              if rows[i][0] is not None and rows[j][0] is not None and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    low = smallest_reachable([d if d is not None else -1 for d, _ in rows], linked)
    exp = [(d, len(s), c if d is not None else None, d is None or d == c) for (d, _), s, c in zip(rows, sets, low)]
    assert rows_of(near_dedup.near_duplicates(documents(spark, rows))) == sorted(exp, key=str)
    assert near_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_large_buckets_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIR_BLOCK", 3)
    monkeypatch.setattr(near_dedup, "MAX_BROADCAST_IDS", 1)
    test_near_duplicates_equal_brute_force(spark)


def test_one_of_each_group_stays(spark):
    docs = documents(spark, near_rows())
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = rows_of(kept, "doc_id", "text")
    assert len(left) == len(set(left)) and (11, "ONE TWO") not in left and (10, "one two") in left and (1, None) in left
    assert near_dedup.near_duplicates(kept).where("not kept").count() == 0


def test_rows_go_by_id_and_text(spark):
    near, clean = [f"n{i}" for i in range(80)], [f"c{i}" for i in range(80)]
    text = lambda w, *more: " ".join([*w, *more])
    rows = [(1, text(near)), (2, text(near, "x")), (2, text(clean)), (2, text(clean)), (3, "other words"), (4, text(near, "y")), (4, "of its own"),
            (5, text(map(str, range(80)))), (5, text(map(str, range(80)), "z")), (None, text(near)), (None, text(near)), (6, ""), (6, ""), (7, None), (7, None)]
    got = rows_of(near_dedup.keep_one(documents(spark, rows)), "doc_id", "text")
    five = [r for r in got if r[0] == 5]
    assert len(five) == 1 and five[0] in rows
    assert [r for r in got if r[0] != 5] == sorted(
        [(1, text(near)), (2, text(clean)), (3, "other words"), (4, "of its own"), (None, text(near)), (None, text(near)), (6, ""), (6, ""),
         (7, None), (7, None)], key=str)


def test_contaminated_rows_go_by_id_and_text(spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, "x " + PASSAGE), (1, "clean words"), (1, "clean words"), (None, PASSAGE), (None, "clean too"), (None, None), (2, PASSAGE), (3, "")]
    got = corpus_pipeline.drop_contaminated(spark, documents(spark, rows), str(tmp_path))
    assert got.columns == documents(spark, rows).columns
    assert rows_of(got, "doc_id", "text") == sorted([rows[1], rows[2], rows[4], rows[5], rows[7]], key=str)


def test_registers_estimate_and_merge():
    r = np.random.default_rng(3)
    a = r.integers(0, 1 << 63, 2000).astype("u8")
    for share in (0.0, 0.5, 0.9):
        k = int(2000 * share)
        b = np.concatenate([a[:k], r.integers(0, 1 << 63, 2000 - k).astype("u8")])
        same = (near_dedup.registers(a) == near_dedup.registers(b)).mean()
        assert abs(same - k / (4000 - k)) < 0.2
        assert (near_dedup.registers(np.concatenate([a, b])) == np.maximum(near_dedup.registers(a), near_dedup.registers(b))).all()
        passes = near_dedup.may_reach(near_dedup.registers(a)[None], near_dedup.registers(b)[None], np.array([2000.0]), np.array([2000.0]), 0.75)
        assert passes[0] == (share == 0.9)


ITEMS = [(1, " ".join(PASSAGE.split()[10:35])), (2, "alpha beta gamma"), (3, "Ä"), (4, ""), (5, None), (6, "alpha beta gamma"), (None, "one"),
         (7, "two"), (8, "t5x5 t6x6 t7x7 t8x8 t9x9 t10x10"), (9, LONG[:200]), (9, LONG[:200])]


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_contamination_equals_brute_force(spark, broadcast):
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], "item_id long, text string, words int")
    got = rows_of(decontaminate.contamination(documents(spark), items, max_broadcast=broadcast))
    assert got == contaminated(TEXTS, ITEMS)


def test_contamination_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(documents(spark, []), items).count() == 0
    got = decontaminate.contamination(documents(spark), items.limit(0)).collect()
    assert len(got) == len(TEXTS) and not any(r.contaminated for r in got)


def test_contamination_runs_no_python(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").coalesce(1)
    plan = decontaminate.contamination(documents(spark), items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def vectors():
    r = np.random.default_rng(8)
    x = r.standard_normal((300, 24))
    x[50:90] = x[7] + 0.06 * r.standard_normal((40, 24))
    x[120:130] = x[3] * np.linspace(0.1, 9, 10)[:, None]
    x[200:204] = x[200]
    nan, inf = float("nan"), float("inf")
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 24), (902, [None] + [1.0] * 23), (903, [nan] + [1.0] * 23), (904, [inf] * 24), (905, []), (906, [1.0, 2.0]),
             (907, [2.0, 4.0]), (908, [1e-200] * 24), (909, [1e200] * 24), (None, [1.0] * 24), (5, [1.0, 0.0])]
    return rows


@pytest.mark.parametrize("tile", [2048, 16])
def test_vectors_equal_brute_force(spark, tile):
    rows = vectors()
    ok = [i is not None and v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v) and any(v) for i, v in rows]
    unit = [np.array(v) / np.abs(v).max() if o else None for (_, v), o in zip(rows, ok)]
    linked = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        if ok[i] and ok[j] and len(unit[i]) == len(unit[j]):
            if unit[i] @ unit[j] / np.sqrt((unit[i] @ unit[i]) * (unit[j] @ unit[j])) >= 0.95:
                linked.add((i, j))
    n = [sum(k in p for p in linked) for k in range(len(rows))]
    low = smallest_reachable([i if i is not None else 10**9 for i, _ in rows], linked)
    exp = [(i, n[k], low[k] if i is not None else None, i is None or low[k] == i) for k, (i, _) in enumerate(rows)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, node int, weight int")
    assert rows_of(embeddings.near_vectors(df, tile_rows=tile)) == sorted(exp, key=str)
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def links_by_force(ids, x, least=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = np.argwhere(np.triu(unit @ unit.T >= least, 1))
    n = np.bincount(linked.ravel(), minlength=len(ids))
    low = smallest_reachable(ids, {tuple(p) for p in linked.tolist()})
    return sorted(zip(ids, n.tolist(), low, [a == b for a, b in zip(ids, low)]), key=str)


def test_vector_blocks_meet_without_a_shuffle(spark, monkeypatch):
    plans, plain = {}, embeddings.written

    def kept(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, purpose)

    monkeypatch.setattr(embeddings, "written", kept)
    r = np.random.default_rng(3)
    x = r.standard_normal((900, 24)).astype(np.float32)
    x[100:400] = x[5] + 0.1 * r.standard_normal((300, 24))  # a group with links in every block
    x[600:700] = x[600]  # copies, in more than one batch
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)
    got = rows_of(embeddings.near_vectors(df, tile_rows=64, levels=(4, 8)))
    assert got == links_by_force(list(range(900)), x.astype(float))
    assert "Exchange" not in plans["vector-links"]  # else a copy of each tile goes out for every tile within reach


def test_vector_blocks_are_bounded_under_ties(spark, monkeypatch):
    tables, plain = {}, embeddings.written

    def kept(df, purpose):
        tables[purpose] = plain(df, purpose)
        return tables[purpose]

    monkeypatch.setattr(embeddings, "written", kept)
    r = np.random.default_rng(4)
    x = np.vstack([r.standard_normal(8) * 2.0 ** np.arange(-150, 150)[:, None], r.standard_normal((100, 8))])  # 300 of one direction
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert rows_of(embeddings.near_vectors(df, tile_rows=16)) == links_by_force(list(range(400)), x)
    assert max(len(b.nodes) // 8 for b in tables["blocks"].collect()) <= 64
