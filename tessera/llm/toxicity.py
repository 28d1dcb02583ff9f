"""Operator 4: toxicity severity by cumulative-link ordinal regression on sparse text features.

Features are a document's distinct words and their prefixes; those that mark toxic labels are
selected by a distributed count. The model has one weight vector for all grades and ordered
thresholds: P(grade <= k) = sigmoid(threshold_k - w.x). A document's severity is its expected
grade. Labels hold one threshold only (toxic or not); the grades above it are set among the
labelled toxic documents by how many selected terms they hold (equal shares for each grade).

The fit uses at most ``sample_rows`` labelled documents, taken by a hash of the id. Scoring
covers every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6, 7)


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def word_features(word: str) -> list[str]:
    """The word and its proper prefixes (marked by a star)."""
    return [word] + [word[:n] + "*" for n in PREFIXES if len(word) > n]


@dataclass
class SeverityModel:
    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.array([np.inf]))
    _known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def counts(self, text: str | None) -> Counter:
        """Selected features -> distinct words of the text that have them."""
        if len(self._known) > 100_000:
            self._known.clear()
        out: Counter = Counter()
        for w in text_words(text):
            got = self._known.get(w)
            if got is None:
                got = tuple(self.features[f] for f in word_features(w) if f in self.features)
                if len(w) <= 64:
                    self._known[w] = got
            if got:
                out.update(got)
        return out

    def latent(self, text: str | None) -> float:
        return sum(self.weights[j] * np.log1p(n) for j, n in self.counts(text).items())

    def at_least(self, latent: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1.. as columns."""
        z = np.clip(self.thresholds[None, :] - np.asarray(latent, float)[:, None], -500, 500)
        return 1 - 1 / (1 + np.exp(-z))


def fit_ordinal(x: np.ndarray, grade: np.ndarray, grades: int, l2: float = 2e-5, steps: int = 1000, rate: float = 0.1):
    """Proportional odds by Adam on the mean log likelihood; returns weights and ordered thresholds."""
    n, d = x.shape
    w = np.zeros(d)
    raw = np.concatenate([[2.0], np.zeros(grades - 1)])  # first threshold, then log gaps
    mw, vw, mr, vr = np.zeros(d), np.zeros(d), np.zeros(grades), np.zeros(grades)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    rows = np.arange(n)
    for t in range(1, steps + 1):
        gaps = np.exp(raw[1:])
        theta = np.concatenate([[raw[0]], raw[0] + np.cumsum(gaps)])
        low = np.concatenate([[-np.inf], theta])[grade] - (s := x @ w)
        high = np.concatenate([theta, [np.inf]])[grade] - s
        a, b = sig(low), sig(high)
        p = np.maximum(b - a, 1e-9)
        da, db = a * (1 - a) / p, b * (1 - b) / p
        gs = (da - db) / n * -1  # d(-ll)/ds = (b' - a') / p
        gw = x.T @ gs + l2 * w
        gt = np.zeros((n, grades))
        up, down = grade < grades, grade > 0
        gt[rows[up], grade[up]] -= db[up] / n
        gt[rows[down], grade[down] - 1] += da[down] / n
        gt = gt.sum(0)
        graw = np.concatenate([[gt.sum()], np.cumsum(gt[::-1])[::-1][1:] * gaps])
        for g, v, m, q in ((gw, w, mw, vw), (graw, raw, mr, vr)):
            m *= 0.9
            m += 0.1 * g
            q *= 0.999
            q += 0.001 * g * g
            v -= rate * (m / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-9)
    return w, np.concatenate([[raw[0]], raw[0] + np.cumsum(np.exp(raw[1:]))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_rows: int = 6_000, max_features: int = 512, grades: int = 3) -> SeverityModel:
    """A model from at most ``sample_rows`` labelled documents. Without both labels (or an empty
    table) the model marks nothing. Rows with a null id, label or text aren't used; of documents that share
    an id and a label one is used, by a hash of the text, so that repeated ids don't widen the sample."""
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id is not null and y is not null").orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample_rows))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    # a text per chosen id and label: sample_rows at most, whatever the rows of an id
    one = texts.join(F.broadcast(chosen.distinct()), "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = written(one.select("y", "text"), "toxicity-sample")
    by_y = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = by_y.get(1, 0), by_y.get(0, 0)
    if not n1 or not n0:
        return SeverityModel()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = (Counter(), Counter())
        for b in batches:
            for y, t in zip(b["y"], b["text"]):
                seen[int(y == 1)].update({f for w in text_words(t) for f in word_features(w)})
        names = list(seen[0] | seen[1])
        yield pd.DataFrame({"f": pd.Series(names, dtype=object), "c1": [seen[1][f] for f in names], "c0": [seen[0][f] for f in names]})

    c1, c0 = F.col("c1") / n1, F.col("c0") / n0
    picked = (sample.mapInPandas(count, "f string, c1 long, c0 long").groupBy("f").agg(F.sum("c1").alias("c1"), F.sum("c0").alias("c0"))
              .where((F.col("c1") >= 4) & (c1 > 5 * c0))
              .withColumn("z", (c1 - c0) / F.sqrt((F.col("c1") + F.col("c0")) / (n0 + n1) / n1))
              .where("z > 4").orderBy(F.desc("z"), "f").limit(max_features).collect())
    model = SeverityModel({r["f"]: j for j, r in enumerate(picked)}, np.zeros(len(picked)))
    if not picked:
        return SeverityModel()

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [model.counts(t) for t in b["text"]]
            yield pd.DataFrame({"y": b["y"], "j": [list(c) for c in got], "n": [list(c.values()) for c in got]})

    got = sample.mapInPandas(rows, "y int, j array<int>, n array<int>").collect()  # sample_rows rows of selected features
    x = np.zeros((len(got), len(picked)))
    for i, r in enumerate(got):
        x[i, r["j"]] = np.log1p(r["n"])
    y = np.array([r["y"] for r in got]) == 1
    evidence = x.sum(1)
    cuts = np.quantile(evidence[y], np.arange(1, grades) / grades)
    grade = np.where(y, 1 + np.searchsorted(cuts, evidence, side="left"), 0)
    model.weights, model.thresholds = fit_ordinal(x, grade, grades)
    return model


def score(docs: DataFrame, model: SeverityModel, id_col: str = "doc_id", text_col: str = "text", at: float = 0.3) -> DataFrame:
    """One row per input row: doc_id, severity (expected grade, 0 to the highest), p_toxic (P(grade >= 1)),
    toxic (p_toxic >= ``at``). Null and empty texts score as texts without any feature; repeated rows
    stay; other columns are ignored; an empty table gives no rows."""
    s, tox = _scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text", model, at)
    return s.select("doc_id", f"{tox}.severity", f"{tox}.p_toxic", f"{tox}.toxic")


def _scored(docs: DataFrame, text_col: str, model: SeverityModel, at: float) -> tuple[DataFrame, str]:
    """``docs`` with the model's figures in a column of its own, and that column's name."""
    @F.pandas_udf("severity double, p_toxic double, toxic boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            p = model.at_least(np.array([model.latent(t) for t in texts], float))
            yield pd.DataFrame({"severity": p.sum(1), "p_toxic": p[:, 0], "toxic": p[:, 0] >= at})

    name = "_tox"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, run(F.coalesce(F.col(text_col), F.lit("")))), name


def keep_clean(docs: DataFrame, model: SeverityModel, text_col: str = "text", at: float = 0.3) -> DataFrame:
    """``docs`` without the rows marked toxic, columns as they were, whatever their names. Null and empty texts stay,
    repeated rows are judged alike, an empty table gives no rows."""
    names = docs.columns
    s, tox = _scored(docs, text_col, model, at)
    return s.where(f"not {tox}.toxic").select(*[f"`{c}`" for c in names])
