"""Operator 6: near-duplicate documents by SetSketch registers.

Each document's set of word shingles is hashed, and every register keeps the smallest of the
exponential values its elements draw, on an exponentially spaced scale, cut to 16 bits
(K = floor(-log_b min x) + shift). Registers of a union are the larger of the two, so
sketches merge; with b = 1.001 equal registers are about as frequent as the Jaccard
similarity, so runs of registers serve as bands. Documents that share a band are estimated
jointly by the likelihood of how many registers are larger, smaller and equal, given both
set sizes; pairs that the likelihood doesn't rule out are verified on their full sets.

Copies (equal sets) are one node. In each band bucket the members are first compared with the
bucket's first one; after that only members of different components are compared, within the
families that unresolved buckets connect, block by block; such a task returns the links that
join components, so no rows are made in the square of a group's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import U64, component_labels, kgrams, mix, split_words, word_hashes, written

BANDS, ROWS = 32, 3
REGISTERS = BANDS * ROWS
BASE, SHIFT = 1.001, 4_000
_LOG = np.log(BASE)
_MULTIPLIERS = np.random.default_rng(20240613).integers(1 << 62, 1 << 63, REGISTERS, dtype=U64) * U64(2) + U64(1)
# The likelihood ratio (log) beyond which a pair is ruled out: about five standard errors.
MARGIN = 12.5
# A cheap test before the likelihood: at a similarity of 0.75, fewer equal registers than this has odds of 1e-13.
LEAST_EQUAL = 38
MAX_BROADCAST_IDS = 200_000
PAIR_BLOCK = 1024


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words (A-Z lower-cased); of a shorter text the whole
    sequence; empty without words."""
    w = split_words(text, lower=True)
    if not w:
        return np.zeros(0, U64)
    h = word_hashes(w, len(w))
    k = min(words, len(w))
    g = mix(kgrams(h, k) + U64(k))
    return np.unique(g)


def registers(s: np.ndarray) -> np.ndarray:
    top = np.zeros(REGISTERS, U64)
    for i in range(0, len(s), 2048):
        np.maximum(top, np.multiply.outer(s[i : i + 2048], _MULTIPLIERS).max(axis=0), out=top)
    small = ((~top).astype(float) + 0.5) / 2.0**64  # 1 - the largest uniform value
    x = -np.log1p(-small)
    return np.clip(np.floor(-np.log(x) / _LOG) + SHIFT, 0, 65535).astype("<u2")


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / _LOG


def may_reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> np.ndarray:
    """Whether the pairs (rows of registers and set sizes) may have a similarity of ``least``: the best
    likelihood at or above it is within MARGIN of the best one at all."""
    if not len(a):
        return np.zeros(0, bool)
    up, down = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = REGISTERS - up - down
    u = (na / (na + nb))[:, None]
    v = 1 - u
    most = np.minimum(na, nb)[:, None] / np.maximum(na, nb)[:, None]
    j = most * np.linspace(0, 1, 81)[None, :]
    j = np.concatenate([j, np.minimum(least, most)], axis=1)
    more, less = _p(np.maximum(u - v * j, 1e-12)), _p(np.maximum(v - u * j, 1e-12))
    ll = up * np.log(more) + down * np.log(less) + same * np.log(np.maximum(1 - more - less, 1e-12))
    high = np.where(j >= least - 1e-12, ll, -np.inf).max(1)
    return (most[:, 0] >= least - 1e-12) & (high >= ll.max(1) - MARGIN)


def sketches(docs: DataFrame, words: int = 5) -> DataFrame:
    """(doc_id, row, n_shingles, node, regs) per row of (doc_id, row, text); node is a hash of the set, null if empty."""
    id_type = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ns, nodes, regs = [], [], []
            for t in b["text"]:
                s = shingle_set(t, words)
                ns.append(len(s))
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype(object), "row": b["row"], "n_shingles": np.array(ns, "int64"),
                                "node": pd.Series(nodes, dtype=object, index=b.index), "regs": pd.Series(regs, dtype=object, index=b.index)})

    return docs.mapInPandas(run, f"doc_id {id_type}, row long, n_shingles long, node long, regs binary")


def _estimate(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) that the likelihood doesn't rule out."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"regs{x}"))

    @F.pandas_udf("boolean")
    def passes(ra: pd.Series, rb: pd.Series, na: pd.Series, nb: pd.Series) -> pd.Series:
        regs = [np.frombuffer(b"".join(r), "<u2").reshape(-1, REGISTERS) for r in (ra, rb)]
        return pd.Series(may_reach(*regs, na.to_numpy(float), nb.to_numpy(float), least))

    # sizes rule out first
    sized = pairs.join(side("a").drop("regsa"), "a").join(side("b").drop("regsb"), "b").where(
        F.least("na", "nb") >= least * F.greatest("na", "nb") - 1e-9)
    both = sized.join(side("a").drop("na"), "a").join(side("b").drop("nb"), "b")
    return both.where(passes("regsa", "regsb", "na", "nb")).select("a", "b")


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether 100 * |intersection| >= 100 least * |union| of two sorted sets of distinct hashes."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= round(100 * least) * (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose full sets have 100 * |intersection| >= 100 least * |union|."""

    @F.pandas_udf("boolean")
    def linked(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_alike(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), least) for x, y in zip(a, b)], dtype=bool)

    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(linked("seta", "setb")).select("a", "b")


def _sets(docs: DataFrame, firsts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of the wanted nodes, made again from a document that has them."""
    ids = written(wanted.join(firsts, "node").select("doc_id", "node"), "near-ids")
    few = ids.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id").select("node", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [shingle_set(t, words) for t in b["text"]]
            own = [xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) == n if len(s) else False for s, n in zip(got, b["node"])]
            yield pd.DataFrame({"node": np.array([n for n, o in zip(b["node"], own) if o], "int64"),
                                "shingles": pd.Series([s.astype("<u8").tobytes() for s, o in zip(got, own) if o], dtype=object)})

    # an id whose row repeats gives its set twice
    return written(texts.mapInPandas(run, "node long, shingles binary").dropDuplicates(["node"]), "near-sets")


def _new_links(left: pd.DataFrame, right: pd.DataFrame | None, least: float) -> list[tuple[int, int]]:
    """Links between rows of different components: of ``left`` and ``right``, or within ``left``. Pairs that
    a link found here has brought together are skipped; all others that the likelihood leaves are verified."""
    both = left if right is None else pd.concat([left, right], ignore_index=True)
    node, n, k = both["node"].to_numpy(), both["n"].to_numpy(float), len(left)
    regs = np.frombuffer(b"".join(both["regs"]), "<u2").reshape(-1, REGISTERS)
    sets = [np.frombuffer(x, "<u8") for x in both["shingles"]]
    root = np.unique(both["part"].to_numpy(), return_inverse=True)[1]
    out = []
    for x in range(k):
        y = np.arange(x + 1 if right is None else k, len(both))
        y = y[(root[y] != root[x]) & (np.minimum(n[y], n[x]) >= least * np.maximum(n[y], n[x]) - 1e-9)]
        if not len(y):
            continue
        same = (regs[y] == regs[x]).sum(1)
        y, same = y[same >= LEAST_EQUAL * least / 0.75], same[same >= LEAST_EQUAL * least / 0.75]
        ok = may_reach(np.broadcast_to(regs[x], (len(y), REGISTERS)), regs[y], np.full(len(y), n[x]), n[y], least)
        for i in y[ok][np.argsort(-same[ok], kind="stable")]:
            if root[i] != root[x] and _alike(sets[x], sets[i], least):
                out.append((int(node[x]), int(node[i])))
                root[root == root[i]] = root[x]
    return out


def _links_across(own: DataFrame, nodes: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """(a, b): links between components, enough to join all that hang together, within each family of
    ``own`` (node, part, family). Families of at most PAIR_BLOCK members are dealt to bins whole."""
    sizes = own.groupBy("family").agg(F.count(F.lit(1)).alias("size"))
    at = F.row_number().over(Window.partitionBy("family").orderBy("part", "node")) - 1
    rows = own.withColumn("block", F.floor(at / PAIR_BLOCK).cast("int")).join(sizes, "family")
    blocks = rows.groupBy("family", "block").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.max("size").alias("size"))
    other = blocks.select("family", F.col("block").alias("other"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"))
    # two blocks of one and the same component have nothing to compare
    pairs = blocks.join(other, "family").where("block <= other and not (lo = hi and lo2 = hi2 and lo = lo2)").select(
        "family", F.col("block").alias("i"), F.col("other").alias("j"))
    pairs = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    few = 16 * int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bin_of = F.when(F.col("size") <= PAIR_BLOCK, F.pmod(F.xxhash64("family"), F.lit(few))).otherwise(F.xxhash64("family", "i", "j"))
    rows = rows.join(pairs, ["family", "block"]).withColumn("bin", bin_of).select("bin", "family", "i", "j", "block", "part", "node")
    rows = rows.join(nodes, "node").join(sets, "node")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), g in pdf.groupby(["family", "i", "j"], sort=False):
            left = g[g["block"] == i].reset_index(drop=True)
            out += _new_links(left, None if i == j else g[g["block"] == j].reset_index(drop=True), least)
        return pd.DataFrame({"a": np.array([x for x, _ in out], "int64"), "b": np.array([x for _, x in out], "int64")})

    return rows.groupBy("bin").applyInPandas(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, least: float = 0.75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest id reachable), kept.

    Null and empty texts have empty sets and link with nothing; rows of a null id get their
    shingle count, no component and are kept; repeated rows are copies of each other; ids that
    repeat with different texts are judged row by row; other columns are ignored; an empty
    table gives an empty result.
    """
    return _judged(docs, id_col, text_col, words, least).select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, id_col: str, text_col: str, words: int = 5, least: float = 0.75) -> DataFrame:
    """``near_duplicates`` with ``row``, a hash of the text, and ``part``, the row's group (null without words)."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("row"))
    sk = written(sketches(d, words), "sketches")
    valid = sk.where("doc_id is not null and node is not null")
    # copies: one node; the sums of a large group are combined in the tasks
    firsts = written(valid.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "nodes")
    nodes = written(valid.join(firsts, ["node", "doc_id"], "left_semi").dropDuplicates(["node"]).select(
        "node", F.col("n_shingles").alias("n"), "regs"), "node-sketches")

    band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("regs", i * (2 * ROWS) + 1, F.lit(2 * ROWS))))
    in_bucket = Window.partitionBy("band")
    members = nodes.select("node", F.explode(band).alias("band")).withColumn("first", F.min("node").over(in_bucket)).withColumn(
        "size", F.count(F.lit(1)).over(in_bucket))
    members = written(members.where("size > 1"), "buckets")

    # each member with its bucket's first
    star = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    star = written(_estimate(star, nodes, least), "star-pairs")
    ends = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    links = written(_verified(star, _sets(d, firsts, ends, words), least), "star-links")
    labels = component_labels(links, "near-components")

    # buckets that still hold several components: what shares such buckets is a family, and every link
    # not yet found lies within one. A family's members are compared across components in blocks of
    # members, each pair of blocks once, with sketches and sets at hand; only new links come back
    tagged = members.join(labels, "node", "left").withColumn("part", F.coalesce("component", "node")).select("band", "node", "part", "first")
    spread = tagged.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi").select("band")
    rest = written(tagged.join(spread, "band"), "rest")
    if not rest.isEmpty():
        families = component_labels(rest.select(F.col("first").alias("a"), F.col("node").alias("b")), "families")
        own = written(rest.select("node", "part").distinct().join(families.withColumnRenamed("component", "family"), "node"), "family-members")
        sets = _sets(d, firsts, own.select("node"), words)
        more = written(_links_across(own, nodes, sets, least), "cross-links")
        if not more.isEmpty():
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = component_labels(known.union(more), "near-components")

    part = labels.join(firsts, "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_node = firsts.join(labels, "node", "left").join(part, "component", "left").select(
        "node", F.coalesce("component", "node").alias("part"), F.coalesce("component_id", "doc_id").alias("component_id"))
    out = sk.join(of_node, "node", "left").select(
        "doc_id", "row", "n_shingles", "part", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of smallest id (of its rows one).
    Rows without an id or without words stay, as does an id's row that is no duplicate."""
    found = _judged(docs, id_col, text_col).where("doc_id is not null and part is not null")
    found = written(found.select("doc_id", "row", "part", "kept"), "near-found")
    # an id may stand at several rows of its group: of different texts one stays, and of its copies one
    repeated = found.where("kept").groupBy("doc_id", "part").agg(F.min("row").alias("low"), F.count(F.lit(1)).alias("n"))
    repeated = written(repeated.where("n > 1").drop("n"), "near-repeated")
    other = found.where("kept").join(repeated, ["doc_id", "part"]).where("row <> low")
    gone = written(found.where("not kept").select("doc_id", "row").union(other.select("doc_id", "row")).distinct(), "near-gone")

    def rows_in(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        few = keys.limit(MAX_BROADCAST_IDS + 1).count() <= MAX_BROADCAST_IDS
        same = (rows[id_col] == keys["doc_id"]) & (F.xxhash64(rows[text_col]) == keys["row"])
        return rows.join(F.broadcast(keys) if few else keys, same, how)

    # a row goes by its id and text: other rows of the id are judged on their own
    rows = rows_in(docs, gone.select("doc_id", "row"), "left_anti")
    if repeated.isEmpty():
        return rows
    copies = repeated.select("doc_id", F.col("low").alias("row"))
    return rows_in(rows, copies, "left_anti").union(rows_in(rows, copies, "left_semi").dropDuplicates([id_col, text_col]))
