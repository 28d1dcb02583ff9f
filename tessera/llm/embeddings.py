"""Operator 10: near-duplicate vectors by PCA-ordered tiled comparison.

Vectors are scaled to length one and turned to principal components, largest variance first
(an orthogonal turn keeps cosines). They are dealt to blocks along the first component and
sorted by the second there; rows are compared unless they lie too far apart along either for the
threshold. The products of the leading components come first, a strip of rows by a tile: with the
norms of what is left out as a further component, one matrix product bounds every cosine from
above. Bounds are made in 32 bits, with an allowance for their rounding. Pairs whose bound falls
short stop there; the others take further components, with the bound renewed, and what may reach
the threshold at the end is decided in 64 bits on the vectors as given.

Equal vectors are one (a group of copies costs one comparison). The vectors are shuffled once
and written once, in blocks; pairs of blocks meet as a product of the written table with
itself, read by each task, so that no copy of a block is shuffled or kept on disk. A pair of
blocks returns a row per linked vector (how many links, and one it hangs together with there),
never the pairs. Work grows with the pairs of rows that these two components can't rule out;
what is shuffled and written of the vectors doesn't.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import component_labels, written

SLACK = 1e-9  # for rounding in bounds; links are decided on the vectors themselves
BLOCK_TILES, LEAST_BLOCKS = 8, 16  # a block's rows in tiles at most; blocks at least, if there are that many tiles
BLOCK_BYTES, HELD_BYTES = 8 << 20, 96 << 20  # of a block's vectors in 64 bits, beyond one tile; of the blocks a worker keeps
STRIP, PARTS = 128, 1 << 20  # rows of a product; numbers gathered at once for the pairs that are left
BATCH_BYTES = "8m"  # of Arrow, where a row is a pair of blocks


def _valid(vec):
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two, so that squares neither overflow nor vanish; no digit is lost."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def _wide(x: np.ndarray) -> np.ndarray:
    """The rows in 64 bits, scaled if they aren't 32-bit numbers, whose squares fit."""
    return x.astype(float) if x.dtype == np.float32 else _scaled(x)


def _unit(x: np.ndarray) -> np.ndarray:
    x = _wide(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def principal_axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, int]:
    """Columns: the directions of the unit vectors, by falling variance; and the rows summed up. Summed in the
    tasks, copies in a batch once; one dim x dim matrix per task is added up by Spark, and the driver gets the sum."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim + 1, dim + 1))
        for b in batches:
            _, once = np.unique(b.column("node").to_numpy(), return_index=True)
            x = _unit(_matrix(b, dim)[once])
            x = np.hstack([x, np.ones((len(x), 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"i": np.arange(total.size, dtype="int32"), "s": total.ravel()})

    rows = vectors.select("node", "v").mapInArrow(moments, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()  # (dim + 1)^2 numbers
    m = np.zeros((dim + 1) ** 2)
    for r in rows:
        m[r["i"]] = r["s"]
    m = m.reshape(dim + 1, dim + 1)
    n = max(m[-1, -1], 1.0)
    _, axes = np.linalg.eigh(m[:dim, :dim] / n - np.outer(m[:dim, -1], m[:dim, -1]) / n**2)
    return np.ascontiguousarray(axes[:, ::-1]), int(n)


def _along(x: np.ndarray, axis: np.ndarray) -> np.ndarray:
    """Each row's component along ``axis``. Summed row by row: a matrix product may round a row by its place."""
    return (_unit(x) * axis).sum(axis=1)


class Block:
    """Vectors by rising second component (blocks are cut along the first), as given and turned, with what the bounds need."""

    def __init__(self, nodes: np.ndarray, weights: np.ndarray, raw: np.ndarray, axes: np.ndarray, levels: tuple[int, ...], cols: int):
        n, dim = raw.shape
        self.levels = tuple(x for x in levels if x < dim) or (dim,)
        first = self.levels[0]
        turned, rest = np.empty((n, dim), np.float32), np.empty((n, len(self.levels)), np.float32)
        along = np.empty(n)
        for s in range(0, n, 2048):
            x = _wide(raw[s : s + 2048])
            x = x @ axes / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
            along[s : s + 2048], turned[s : s + 2048] = x[:, min(1, dim - 1)], x
            rest[s : s + 2048] = np.stack([np.sqrt((x[:, d:] ** 2).sum(1)) for d in self.levels], axis=1)
        order = np.argsort(along, kind="stable")
        self.nodes, self.weights, self.raw, self.along = nodes[order], weights[order], raw[order], along[order]
        self.turned = turned[order]
        self.rest = {d: rest[order, k] for k, d in enumerate(self.levels)}
        self.lead = np.hstack([self.turned[:, :first], self.rest[first][:, None]])
        self.across = np.zeros((first + 1, -(-n // cols) * cols), np.float32)  # whole tiles
        self.across[:, :n] = self.lead.T

    def __len__(self) -> int:
        return len(self.nodes)


def _bar(least: float, terms: int) -> np.float32:
    """What a product in 32 bits reaches if the cosine reaches ``least``: of vectors of length one it is off by
    less than (terms + 4) 2^-24, rounding of the components included; twice that is allowed."""
    return np.float32(least - SLACK - (terms + 4) * 2.0**-23)


def linked_pairs(a: Block, b: Block, least: float, cols: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of all rows of ``a`` and ``b`` whose cosine reaches ``least``, part by part; i < j if they are one block."""
    reach = (2 - 2 * least) ** 0.5 + SLACK
    bar = _bar(least, a.levels[0])
    product, highest = np.empty((STRIP, cols), np.float32), np.empty(cols, np.float32)
    part = max(1, PARTS // a.turned.shape[1])
    held, n = [], 0
    for s in range(0, len(a), STRIP):
        strip = a.lead[s : s + STRIP]
        lo = np.searchsorted(b.along, a.along[s] - reach)
        hi = np.searchsorted(b.along, a.along[s + len(strip) - 1] + reach, side="right")
        if a is b:
            lo = max(lo, s)
        p = product[: len(strip)]
        for q in range(int(lo) // cols * cols, int(hi), cols):
            np.matmul(strip, b.across[:, q : q + cols], out=p)
            np.maximum.reduce(p, axis=0, out=highest)
            some = np.flatnonzero(highest >= bar)  # few columns have a pair
            if not len(some):
                continue
            i, k = np.nonzero(p[:, some] >= bar)
            i, j = i + s, some[k] + q
            ok = (j < len(b)) & (i < j) if a is b else j < len(b)
            held.append((i[ok], j[ok]))
            n += len(held[-1][0])
            if n >= part:
                yield from _confirmed(a, b, held, least, part)
                held, n = [], 0
    if n:
        yield from _confirmed(a, b, held, least, part)


def _confirmed(a: Block, b: Block, pairs: list[tuple[np.ndarray, np.ndarray]], least: float, part: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of (i, j) those whose cosine reaches ``least``; bounded memory, however many there are."""
    i, j = np.concatenate([x for x, _ in pairs]), np.concatenate([y for _, y in pairs])
    dim = a.turned.shape[1]
    bar = _bar(least, dim + len(a.levels))
    for s in range(0, len(i), part):
        x, y = i[s : s + part], j[s : s + part]
        d = a.levels[0]
        done = np.einsum("ij,ij->i", a.turned[x, :d], b.turned[y, :d])
        for nxt in (*a.levels[1:], dim):
            done = done + np.einsum("ij,ij->i", a.turned[x, d:nxt], b.turned[y, d:nxt])
            ok = done + a.rest[nxt][x] * b.rest[nxt][y] >= bar if nxt < dim else done >= bar
            x, y, done, d = x[ok], y[ok], done[ok], nxt
            if not len(x):
                break
        if len(x):
            p, q = _wide(a.raw[x]), _wide(b.raw[y])
            cos = np.einsum("ij,ij->i", p, q) / np.sqrt(np.einsum("ij,ij->i", p, p) * np.einsum("ij,ij->i", q, q))
            ok = cos >= least
            yield x[ok], y[ok]


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``root`` (per row the first row that it hangs together with) after further links (i, j) of rows."""
    while True:
        x, y = root[i], root[j]
        apart = x != y
        if not apart.any():
            return root
        i, j, x, y = i[apart], j[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not (root == (up := root[root])).all():
            root = up


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.95,
                 tile_rows: int = 2048, levels: tuple[int, ...] = (16, 32)) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id (smallest id reachable), kept.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    as do vectors of different lengths with each other and rows of a null id. Rows that
    repeat an id are vectors of their own; other columns are ignored; an empty table gives an
    empty result. ``tile_rows`` bounds a task's memory: two blocks of at most 8 tiles, or of a
    tile if its vectors fill 8 MB, those made last, and a strip of products.
    """
    kind = "float" if vectors.select(vec_col).schema[0].dataType == T.ArrayType(T.FloatType()) else "double"
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind}>").alias("v"))
    v = v.withColumn("ok", F.coalesce(_valid("v"), F.lit(False)) & F.col("vec_id").isNotNull())
    v = v.withColumn("node", F.when(F.col("ok"), F.xxhash64("v")))
    good = v.where("ok")
    # copies: the smallest id stands for them, with their number as weight
    same = written(good.groupBy("node").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight")), "vectors")
    dims = [r["d"] for r in good.select(F.size("v").alias("d")).distinct().collect()]  # lengths that occur
    pieces = [_compare(good.where(F.size("v") == d), d, "<f4" if kind == "float" else "<f8", least, tile_rows, levels) for d in sorted(dims)]
    out = v.select("vec_id", "node")
    if not pieces:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = pieces[0]
    for p in pieces[1:]:
        found = found.union(p)
    found = _with_small_batches(found, "vector-links")
    labels = component_labels(found.select(F.col("node").alias("a"), F.col("low").alias("b")), "vector-components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    first = same.select("node", "first", "weight")
    low = labels.join(first, "node").groupBy("component").agg(F.min("first").alias("component_id"))
    by_node = (first.join(links, "node", "left").join(labels, "node", "left").join(low, "component", "left")
               .select("node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component_id", "first").alias("component_id")))
    out = out.join(by_node, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _with_small_batches(pairs: DataFrame, purpose: str) -> DataFrame:
    """``written``, with few bytes in an Arrow batch: a worker holds a batch besides its blocks."""
    conf, key = pairs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    was = conf.get(key)
    conf.set(key, BATCH_BYTES)
    try:
        return written(pairs, purpose)
    finally:
        conf.set(key, was)


def _compare(good: DataFrame, dim: int, dtype: str, least: float, tile_rows: int, levels: tuple[int, ...]) -> DataFrame:
    """(node, low, links): per vector and pair of blocks its weighted links and a node it hangs together with."""
    axes, n = principal_axes(good, dim)
    axis = np.ascontiguousarray(axes[:, 0])
    cols = min(tile_rows, 2048)
    most = max(tile_rows, min(BLOCK_TILES * tile_rows, BLOCK_BYTES // (8 * dim)))
    blocks = max(-(-n // most), min(-(-n // tile_rows), LEAST_BLOCKS))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pydict({"p": _along(_matrix(b, dim), axis)})

    # borders from quantiles (8 bytes a block); a border that occurs more than once has so many blocks for the
    # vectors that lie on it. A block meets those within reach: for unit vectors |x - y|^2 <= 2 - 2 least, so no
    # single component differs by more than its root
    cuts = np.sort(good.select("v").mapInArrow(positions, "p double").approxQuantile("p", [k / blocks for k in range(1, blocks)], 0.1 / blocks)) if blocks > 1 else np.zeros(0)
    reach = (2 - 2 * least) ** 0.5 + SLACK
    edges = np.array([-np.inf, *cuts, np.inf])
    last = np.searchsorted(edges[:-1], edges[1:] + reach, side="right") - 1  # last block that begins within reach

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, once, weights = np.unique(b.column("node").to_numpy(), return_index=True, return_counts=True)
            x = _matrix(b, dim)[once].astype(dtype, copy=False)
            p = _along(x, axis)
            low, high = np.searchsorted(cuts, p, side="left"), np.searchsorted(cuts, p, side="right")
            block = np.where(low < high, low + 1 + nodes % np.maximum(high - low, 1), low)
            yield pa.RecordBatch.from_pydict({"block": block.astype("int32"), "node": nodes, "weight": weights.astype("int64"),
                                              "vec": pa.array([r.tobytes() for r in x], pa.binary())})

    def pack(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        nodes, once, of = np.unique(rows["node"].to_numpy(), return_index=True, return_inverse=True)  # copies from other batches
        weights = np.zeros(len(nodes), "<i8")
        np.add.at(weights, of, rows["weight"].to_numpy())
        vecs = rows["vec"].to_pylist()
        block = key[0].as_py()
        return pa.table({"block": pa.array([block], pa.int32()), "last": pa.array([last[block]], pa.int32()), "nodes": [nodes.astype("<i8").tobytes()],
                         "weights": [weights.tobytes()], "vectors": [b"".join([vecs[k] for k in once])]})

    placed = good.select("node", "v").mapInArrow(place, "block int, node long, weight long, vec binary")
    packed = placed.repartition(blocks, "block").groupBy("block").applyInArrow(pack, "block int, last int, nodes binary, weights binary, vectors binary")
    packed = written(packed, "blocks")
    a, b = (packed.select(*[F.col(c).alias(f"{side}_{c}") for c in packed.columns]) for side in "ab")
    i, j = F.col("a_block"), F.col("b_block")
    even = (i + j) % 2 == 0  # of (i, j) and (j, i) one, each as often, so that all tasks have work
    meet = F.when(i <= j, even & (j <= F.col("a_last"))).otherwise(~even & (i <= F.col("b_last")))
    pairs = a.join(b.hint("shuffle_replicate_nl"), meet)  # a product in the tasks: neither side is shuffled or sent to the driver

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, Block] = {}  # the last ones used
        most_made = max(2, HELD_BYTES // (12 * dim * most))

        def block(batch: pa.RecordBatch, row: int, side: str) -> Block:
            k = batch.column(f"{side}_block")[row].as_py()
            if k not in made:
                while len(made) >= most_made:
                    del made[next(iter(made))]
                nodes, weights, raw = (np.frombuffer(batch.column(f"{side}_{c}")[row].as_buffer(), t)
                                       for c, t in (("nodes", "<i8"), ("weights", "<i8"), ("vectors", dtype)))
                made[k] = Block(nodes, weights, raw.reshape(-1, dim), axes, levels, cols)
            made[k] = made.pop(k)
            return made[k]

        for batch in batches:
            for row in range(batch.num_rows):
                x, y = block(batch, row, "a"), block(batch, row, "b")
                shift = 0 if x is y else len(x)
                ids, weight = (x.nodes, x.weights) if x is y else (np.concatenate([x.nodes, y.nodes]), np.concatenate([x.weights, y.weights]))
                links, root = np.zeros(len(ids), "int64"), np.arange(len(ids))
                for i, j in linked_pairs(x, y, least, cols):
                    j = j + shift
                    np.add.at(links, i, weight[j])
                    np.add.at(links, j, weight[i])
                    root = _merge(root, i, j)
                has = np.flatnonzero(links)
                yield pa.RecordBatch.from_pydict({"node": ids[has], "low": ids[root[has]], "links": links[has]})

    return pairs.mapInArrow(compare, "node long, low long, links long")
