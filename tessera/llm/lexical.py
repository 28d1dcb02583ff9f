"""Operator 11: ranked lexical search, exact top-k for a set of queries, by a dual tree.

One scan of the texts keeps, of every document, its length and how often it holds each of the queries' terms, in
packed batches of documents in a written table. Corpus figures (documents, terms, documents per term) are sums over all of it.

In the search, each batch is a tree: documents sorted by their weightiest term in leaves, leaves in branches, and every node holds the
largest impact of each term below it. The queries are a tree likewise (queries, groups, blocks) whose nodes hold the largest weight of
each term. The product of two nodes' maxima is an upper bound for every pair below them; a node pair whose bound is under
the weakest k-th score of its queries goes as a whole. What is left is scored as a matrix product. Scores are whole numbers
below 2^53, so that products in doubles are exact, and pairs that reach the k-th score exactly are kept for the tie rule.

The k-th scores start from a first search of a few batches (they are true scores, so the bound is safe) and rise
within a task. A task hands on k documents a query at most, and those alone are ranked.

Queries go in rounds of a bounded number of bytes: what is shipped to the tasks and held on the driver is bounded by a
round, however many queries there are. Documents are never gathered.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import ship_package, written

BATCH_DOCS, BATCH_TERMS = 1024, 1 << 21  # a batch ends with either
LEAF, BRANCH = 32, 8  # documents a leaf, leaves a branch
GROUP, BLOCK = 16, 16  # queries a group, groups a block
SEED_PARTS = 16  # tasks of the index whose first batch the first search reads
ROUND_BYTES = 8 << 20
EXACT = 1 << 53

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

INDEX = "part int, seq int, n_docs long, n_terms long, ids binary, known binary, lengths binary, doc binary, term binary, tf binary"


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of characters beyond ASCII; only A-Z lower-cased."""
    return text.encode("utf-8").translate(_TABLE).split() if text else []


def index(docs: DataFrame, vocab: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Packed batches of the documents that hold a term of ``vocab``; every document counts in n_docs and n_terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # of one round of queries
    width = max(len(vocab), 1)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, part, seq = shared.value.get, TaskContext.get().partitionId(), 0
        ids, lengths, found, counts, n_docs, n_terms = [], [], [], [], 0, 0

        def row():
            at = np.repeat(np.arange(len(found)), counts)
            key, tf = np.unique(at * width + np.array([t for f in found for t in f], dtype="int64"), return_counts=True)
            known = np.array([i is not None for i in ids], dtype="u1")
            return pd.DataFrame({"part": [part], "seq": [seq], "n_docs": [n_docs], "n_terms": [n_terms],
                                 "ids": [np.array([0 if i is None else i for i in ids], dtype="<i8").tobytes()], "known": [known.tobytes()],
                                 "lengths": [np.array(lengths, dtype="<i8").tobytes()], "doc": [(key // width).astype("<i4").tobytes()],
                                 "term": [(key % width).astype("<i4").tobytes()], "tf": [tf.astype("<i4").tobytes()]})

        held = 0
        for b in batches:
            for doc_id, text in zip(b["id"].astype("Int64"), b["text"]):
                words = terms(text)
                if not words:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(words)
                f = [t for t in map(get, words) if t is not None]
                if f:
                    ids.append(None if doc_id is pd.NA else int(doc_id))
                    lengths.append(len(words))
                    found.append(f)
                    counts.append(len(f))
                    held += len(f)
                if len(ids) >= BATCH_DOCS or held >= BATCH_TERMS:
                    yield row()
                    ids, lengths, found, counts, n_docs, n_terms, held, seq = [], [], [], [], 0, 0, 0, seq + 1
        if n_docs:
            yield row()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInPandas(pack, INDEX)


def corpus_figures(packed: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and the number of documents that hold each term of the round."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n, total = np.zeros(width, "int64"), 0, 0
        for b in batches:
            n, total = n + int(b["n_docs"].sum()), total + int(b["n_terms"].sum())
            for t in b["term"]:
                df += np.bincount(np.frombuffer(t, "<i4"), minlength=width)
        has = np.flatnonzero(df)
        yield pd.DataFrame({"term": [-2, -1, *has], "n": [n, total, *df[has]]})

    rows = packed.select("n_docs", "n_terms", "term").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    got = {r["term"]: r["n"] for r in rows}
    return got.get(-2, 0), got.get(-1, 0), np.array([got.get(t, 0) for t in range(width)], dtype="int64")


@dataclass
class Level:
    """Sparse rows: the terms below a node and the largest weight of each."""

    start: np.ndarray
    term: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, rows: list[dict[int, int]]) -> Level:
        return cls(np.cumsum([0, *map(len, rows)]), np.array([t for r in rows for t in sorted(r)], dtype="int64"),
                   np.array([r[t] for r in rows for t in sorted(r)], dtype="int64"))

    def dense(self, lo: int, hi: int, place: np.ndarray, cols: int, kind: type) -> np.ndarray:
        out = np.zeros((hi - lo, cols), kind)
        s = slice(self.start[lo], self.start[hi])
        at, row = place[self.term[s]], np.repeat(np.arange(hi - lo), np.diff(self.start[lo : hi + 1]))
        out[row[at >= 0], at[at >= 0]] = self.weight[s][at >= 0]
        return out


@dataclass
class QueryTree:
    order: np.ndarray  # tree place -> query number
    levels: tuple[Level, Level, Level]  # queries, groups, blocks
    n_docs: int
    n_terms: int
    width: int
    kind: type = field(default=float)

    @classmethod
    def of(cls, bags: list[dict[int, int]], weight: np.ndarray, n_docs: int, n_terms: int) -> QueryTree:
        """``bags``: per query its terms' counts. Queries are sorted by their weightiest term, so that like ones meet."""
        rows = [{t: c * int(weight[t]) for t, c in b.items() if weight[t] > 0} for b in bags]
        order = sorted(range(len(rows)), key=lambda q: (max(((v, t) for t, v in rows[q].items()), default=(0, -1))[::-1], q))
        rows = [rows[q] for q in order]

        def above(below: list[dict[int, int]], n: int) -> list[dict[int, int]]:
            out = []
            for s in range(0, len(below), n):
                top: dict[int, int] = {}
                for r in below[s : s + n]:
                    for t, v in r.items():
                        top[t] = max(top.get(t, 0), v)
                out.append(top)
            return out

        groups = above(rows, GROUP)
        blocks = above(groups, BLOCK)
        # an impact is below 10^6, so this bounds every score and every bound
        kind = float if max((sum(b.values()) for b in blocks), default=0) * 10**6 < EXACT else np.int64
        return cls(np.array(order, dtype="int64"), (Level.of(rows), Level.of(groups), Level.of(blocks)), n_docs, n_terms, len(weight), kind)


class Best:
    """The k best documents of each query so far, and the score that a further one must reach."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least = k, np.maximum(least, 1)
        self.rows: list[list[tuple[int, int, int]]] = [[] for _ in least]  # (-score, 0 if the id is known, id)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        rows = self.rows[q]
        rows += zip((-scores).tolist(), (1 - known).tolist(), ids.tolist())
        if len(rows) >= self.k:
            rows.sort()
            del rows[self.k :]
            self.least[q] = max(self.least[q], -rows[-1][0])


def _batch(r: dict, tree: QueryTree, weight: np.ndarray):
    """A batch as a tree: ids, known, the local terms' places, leaf maxima, and dense leaves on demand."""
    doc, term, tf = (np.frombuffer(r[c], "<i4").astype("int64") for c in ("doc", "term", "tf"))
    lengths = np.frombuffer(r["lengths"], "<i8")
    m = 75 + (25 * lengths * tree.n_docs) // tree.n_terms
    impact = (10**9 * tf) // (1000 * tf + 12 * m[doc])
    heavy = impact * weight[term]
    by = np.lexsort((term, -heavy, doc))
    first = by[np.searchsorted(doc[by], np.arange(len(lengths)))]  # every document holds a term
    order = np.lexsort((-heavy[first], term[first]))
    rank = np.empty(len(order), "int64")
    rank[order] = np.arange(len(order))
    cols, local = np.unique(term, return_inverse=True)
    place = np.full(tree.width, -1)
    place[cols] = np.arange(len(cols))
    row = rank[doc]
    by = np.argsort(row, kind="stable")
    row, local, impact = row[by], local[by], impact[by]
    leaves = -(-len(order) // LEAF)
    branches = -(-leaves // BRANCH)
    leaf = np.zeros((branches * BRANCH, len(cols)), tree.kind)
    np.maximum.at(leaf, (row // LEAF, local), impact.astype(tree.kind))
    cut = np.searchsorted(row, np.arange(leaves + 1) * LEAF)

    def dense(k: int) -> np.ndarray:
        s = slice(cut[k], cut[k + 1])
        out = np.zeros((min(LEAF, len(order) - k * LEAF), len(cols)), tree.kind)
        out[row[s] - k * LEAF, local[s]] = impact[s]
        return out

    ids, known = np.frombuffer(r["ids"], "<i8")[order], np.frombuffer(r["known"], "u1").astype("int64")[order]
    return ids, known, place, leaf, leaf.reshape(branches, BRANCH, -1).max(1), dense


def search_batch(r: dict, tree: QueryTree, weight: np.ndarray, best: Best) -> int:
    """Meets one batch with all queries; returns the number of pairs of a query and a document that were scored."""
    if not len(r["ids"]):
        return 0
    ids, known, place, leaf, branch, dense = _batch(r, tree, weight)
    cols, scored, leaves = leaf.shape[1], 0, {}
    queries, groups, blocks = tree.levels
    n_groups, n = len(groups.start) - 1, len(tree.order)
    root = branch.max(0)
    least = best.least  # by tree place
    for b in np.flatnonzero(blocks.dense(0, len(blocks.start) - 1, place, cols, tree.kind) @ root >= np.minimum.reduceat(least, np.arange(0, n, GROUP * BLOCK))):
        g0, g1 = b * BLOCK, min((b + 1) * BLOCK, n_groups)
        bound = groups.dense(g0, g1, place, cols, tree.kind) @ branch.T
        weakest = np.minimum.reduceat(least, np.arange(g0 * GROUP, min(g1 * GROUP, n), GROUP))
        for g in np.flatnonzero((bound >= weakest[:, None]).any(1)):
            q0, q1 = (g0 + g) * GROUP, min((g0 + g + 1) * GROUP, n)
            used = place[groups.term[groups.start[g0 + g] : groups.start[g0 + g + 1]]]
            used = used[used >= 0]
            q = queries.dense(q0, q1, place, cols, tree.kind)[:, used]
            below = (np.flatnonzero(bound[g] >= weakest[g])[:, None] * BRANCH + np.arange(BRANCH)).ravel()
            tops = q @ leaf[np.ix_(below, used)].T
            for j in np.argsort(-tops.max(0), kind="stable"):  # promising leaves first: they raise the k-th scores
                on = np.flatnonzero(tops[:, j] >= least[q0:q1])
                if not len(on):
                    continue
                k = int(below[j])
                if k not in leaves:
                    leaves[k] = dense(k)
                scores = (q[on] @ leaves[k][:, used].T).astype("int64")
                scored += scores.size
                s = slice(k * LEAF, k * LEAF + scores.shape[1])
                for i, row in zip(on, scores):
                    ok = row >= least[q0 + i]
                    if ok.any():
                        best.add(q0 + i, row[ok], ids[s][ok], known[s][ok])
    return scored


def _search(packed: DataFrame, shared, least: np.ndarray, k: int) -> DataFrame:
    """Per task and query the k best documents that reach ``least``: query, doc_id, score; a row of query -1 tells the scored pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, weight = shared.value
        best, scored = Best(least[tree.order], k), 0
        for b in batches:
            for r in b.to_dict("records"):
                scored += search_batch(r, tree, weight, best)
        rows = [(int(tree.order[q]), None if unknown else i, -s) for q, found in enumerate(best.rows) for s, unknown, i in found]
        rows.append((-1, None, scored))
        for s in range(0, len(rows), 10_000):
            part = rows[s : s + 10_000]
            yield pd.DataFrame({"query": [r[0] for r in part], "doc_id": pd.Series([r[1] for r in part], dtype="Int64"), "score": [r[2] for r in part]})

    return packed.select("ids", "known", "lengths", "doc", "term", "tf").mapInPandas(run, "query int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.where("query >= 0").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", query_id: str = "item_id",
           query_text: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Each query's k highest-scoring documents with a score above 0: the query's id, rank (from 1), doc_id, score.

    Equal scores go by ascending document id, unknown (null) ids last. Null texts and texts without terms count nowhere and rank
    nowhere; repeated ids and rows are documents of their own. Equal query rows (id and text) are one query, rows
    of one id with different texts are ranked each for itself; a null id is an id. Further columns are ignored, empty tables give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    asked = queries.select(F.col(query_id).alias("id"), F.col(query_text).alias("text")).where("text is not null").distinct()
    asked = written(asked, "lexical-queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    rounds = max(1, -(-size // round_bytes))
    schema = f"id {asked.schema['id'].dataType.simpleString()}, query int"
    out = None
    for r in range(rounds):
        rows = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(rounds)) == r).collect()  # about round_bytes
        vocab: dict[bytes, int] = {}
        bags: list[dict[int, int]] = []
        for row in rows:
            bag: dict[int, int] = {}
            for t in terms(row["text"]):
                t = vocab.setdefault(t, len(vocab))
                bag[t] = bag.get(t, 0) + 1
            bags.append(bag)
        packed = written(index(docs, vocab, id_col, text_col), "lexical-index")
        n_docs, n_terms, df = corpus_figures(packed, len(vocab))
        weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], dtype="int64")
        tree = QueryTree.of(bags, weight, n_docs, max(n_terms, 1))
        shared = spark.sparkContext.broadcast((tree, weight))
        none = np.zeros(len(bags), "int64")
        seeds = _ranked(_search(packed.where(f"seq = 0 and part < {SEED_PARTS}"), shared, none, k), k)
        least = none.copy()
        for s in seeds.where(F.col("rank") == k).select("query", "score").collect():  # a number a query
            least[s["query"]] = s["score"]
        found = _ranked(_search(packed, shared, least, k), k)
        names = spark.createDataFrame([(row["id"], q) for q, row in enumerate(rows)], schema)
        found = found.join(names, "query").select(F.col("id").alias(query_id), F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    return out
