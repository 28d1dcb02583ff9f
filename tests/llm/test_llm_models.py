"""Toxicity, quality, chat formatting, registered queries and the pipeline."""

import collections
import random

import numpy as np
import pytest
from llm_cases import TEXTS, documents, rows_of, sha

import corpus_pipeline
from oracle_check import compare, duck
from tessera.llm import chat, quality, queries, toxicity
from tessera.llm.shared import documents as table_documents
from tessera.llm.shared import ship_package

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def labelled(spark, marks):
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_ordinal_fit_orders_grades():
    r = np.random.default_rng(0)
    x = r.standard_normal((800, 3))
    s = x @ np.array([2.0, -1.0, 0.0])
    grade = np.digitize(s + r.logistic(0, 0.3, 800), [0.5, 2.0])
    w, theta = toxicity.fit_ordinal(x, grade, 2)
    assert theta[0] < theta[1] and w[0] > 0 > w[1] and abs(w[2]) < 0.3
    model = toxicity.SeverityModel({}, w, theta)
    assert np.corrcoef(model.at_least(x @ w).sum(1), grade)[0, 1] > 0.8


def toxic_rows():
    r = random.Random(6)
    rows, marks = [], []
    for i in range(300):
        w = [f"k{r.randint(0, 300)}lm" for _ in range(50)]
        bad = i % 5 == 0
        if bad:
            w[3::9] = ["grumblefoo", "snarkybar", "grumblebaz", "snarkyqux", "grumblefoo", "snarkybar"][: len(w[3::9])]
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(bad)))
    return rows, marks


def test_toxicity_on_held_out_documents(spark):
    rows, marks = toxic_rows()
    model = toxicity.fit(documents(spark, rows[:200]), labelled(spark, marks[:200] + [(None, 1, 1), (7, 1, None)]))
    got = {r.doc_id: r for r in toxicity.score(documents(spark, rows[200:] + [(901, None), (902, ""), (903, "word " * 50_000)]), model).collect()}
    assert all(got[i].toxic == bool(t) for i, _, t in marks[200:])
    assert not any(got[i].toxic for i in (901, 902, 903))
    assert all(0 <= r.severity <= 3 and 0 <= r.p_toxic <= 1 for r in got.values())


def test_toxicity_sample_is_bounded_when_an_id_repeats(spark, monkeypatch):
    rows, marks = toxic_rows()
    rows = rows[:200] + [(7, f"word{i % 50} again")  for i in range(20_000)] + [(5, rows[5][1])] * 3000
    sizes, plain = [], toxicity.written

    def seen(df, purpose):
        out = plain(df, purpose)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(toxicity, "written", seen)
    model = toxicity.fit(documents(spark, rows), labelled(spark, marks[:200] + [(7, 1, 0), (7, 1, 1)]), sample_rows=100)
    assert max(sizes) <= 100 and model.features


def test_toxicity_of_clashing_names_and_empty_tables(spark):
    rows, marks = toxic_rows()
    model = toxicity.fit(documents(spark, rows[:200]), labelled(spark, marks[:200]))
    odd = documents(spark, rows[200:] + [(None, None), (901, "")]).withColumnsRenamed({"batch": "_tox", "row": "_tox_"})
    kept = toxicity.keep_clean(odd, model)
    assert kept.columns == odd.columns and kept.schema == odd.schema
    clean = {i for i, _, t in marks[200:] if not t} | {None, 901}
    assert {r.doc_id for r in kept.collect()} == clean
    none = documents(spark, [])
    assert toxicity.score(none, model).count() == toxicity.keep_clean(none, model).count() == 0


def test_toxicity_without_labels_marks_nothing(spark):
    for marks in ([], [(4, 1, 0), (5, 1, 0)]):
        model = toxicity.fit(documents(spark), labelled(spark, marks))
        got = toxicity.score(documents(spark), model).collect()
        assert len(got) == len(TEXTS) and not any(r.toxic for r in got)
        assert toxicity.keep_clean(documents(spark), model).count() == len(TEXTS)


def test_quality_gradient_is_the_loss_derivative():
    net = quality.ByteConvNet()
    text = "some text ### with bytes é " * 60
    got = net.gradient(text, 1.0)
    loss = lambda: float(np.log1p(np.exp(-net.logit(text))))
    r = np.random.default_rng(1)
    for p, g in zip(net.params(), got):
        for _ in range(4):
            at = tuple(r.integers(0, n) for n in p.shape)
            was, eps = p[at], 2e-3
            p[at] = was + eps
            up = loss()
            p[at] = was - eps
            down = loss()
            p[at] = was
            assert abs((up - down) / (2 * eps) - g[at]) < 2e-2


def test_quality_segments_cover_the_whole_document(monkeypatch):
    net = quality.ByteConvNet()
    text = "abc def " * 3000 + "ÿ" * 500 + "xyz " * 900
    whole = net.logit(text)
    monkeypatch.setattr(quality, "SEGMENT_BLOCKS", 3)
    assert abs(net.logit(text) - whole) < 1e-4
    assert np.isfinite([net.logit(None), net.logit(""), net.logit("a")]).all()


def test_quality_on_held_out_documents(spark):
    got = queries.op7_quality(spark, MEDIUM)
    rows = got.join(spark.read.parquet(f"{MEDIUM}/labels.parquet"), "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    auc = np.mean([[g > b for b in bad] for g in good])
    assert auc > 0.85 and np.mean([r.predicted == r.quality for r in rows]) > 0.85
    out = quality.score(documents(spark), None).collect()
    assert len(out) == len(TEXTS) and {r.score for r in out} == {0.5}


ODD = r"\### Assistant: </turn> ok"
TURNS = [(-7, 0, "user", ODD), (-7, 1, "assistant", ODD), (1, 0, "system", "be \\ kind </turn>"), (1, 1, None, None), (1, 1, "a b:\n%", "\n</turn>\n### x:\n"),
         (1, 2, "assistant", "\\"), (1, 3, "assistant", ""), (None, 1, "assistant", "é <</turn> ####\\###"), (2, None, "user", "hi"), (2, 5, "assistant", "x\n"),
         (2, 5, "assistant", "x\n"), (3, 0, "assistant", "word " * 5000)] + [(4, i, "assistant" if i % 2 else "user", f"turn {i} " * (i % 9 + 1)) for i in range(60)] + [
         (5, i, ("system", "user", "assistant")[0 if i == 0 else 1 + i % 2], f"t{i} ### " * 12) for i in range(30)]


@pytest.mark.parametrize("budget", [40, 512])
def test_chat_round_trip(spark, budget):
    turns = spark.createDataFrame([(*t, 1, "z") for t in TURNS], "conv_id long, turn long, role string, text string, cost int, new string")
    windows = chat.format_chat(turns, budget=budget, history=30)
    got = rows_of(chat.chat_digest(windows), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    by = collections.defaultdict(list)
    for c, n, r, t in TURNS:
        by[c].append((n is not None, n or 0, r or "", t or ""))
    exp = []
    for c, ts in by.items():
        ts.sort()
        loss = "".join(t for _, _, r, t in ts if r == "assistant")
        exp.append((c, len(ts), sha("".join(f"{r}\n{t}\n" for _, _, r, t in ts)), len(loss), sha(loss)))
    assert got == sorted(exp, key=str)
    rows = windows.collect()
    assert all(r.n_new == 1 or r.n_tokens <= budget + 30 + 30 for r in rows)
    assert all(r.formatted.startswith("### system:") for r in rows if r.conv_id in (1, 5))
    assert chat.chat_digest(chat.format_chat(turns.limit(0))).count() == 0
    assert "Python" not in windows._jdf.queryExecution().executedPlan().toString()


def test_every_operator_is_registered_over_whole_tables(spark):
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    n = table_documents(spark, SMALL).count()
    for name in ("op1_token_counts", "op3_secret_scan", "op4_toxicity", "op7_quality"):
        assert names[name](spark, SMALL).count() == n


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    ok, msg = compare(spark, SMALL, name, queries.queries()[name], queries.oracle_sql()[name], duck(SMALL))
    assert ok, msg


def test_pipeline_stages_keep_the_columns_and_take_effect(spark):
    docs = table_documents(spark, SMALL)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
    sizes = [docs.count()]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SMALL).cache()
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes)
        left = {r.doc_id for r in after.collect()}
        assert left <= {r.doc_id for r in before.collect()}
        if name == "near_dedup":
            found = queries.near_dedup.near_duplicates(before)
            assert left == {r.doc_id for r in found.where("kept").collect()}
        if name == "decontamination":
            hit = queries.decontaminate.contamination(before, spark.read.parquet(f"{SMALL}/benchmark.parquet"))
            assert left == {r.doc_id for r in hit.where("not contaminated").collect()}
        if name == "secrets":
            assert len(left) == sizes[-1] and all(len(r.text) == r.n_chars for r in after.collect())
        sizes.append(after.count())
        before = after
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0]
    pieces = corpus_pipeline.run(spark, SMALL)
    assert rows_of(pieces.select("doc_id").distinct()) == rows_of(before.select("doc_id").distinct())
