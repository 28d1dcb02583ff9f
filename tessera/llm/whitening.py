"""Operator 13: whitening of integer-scaled embeddings by pivoted Cholesky and one-sided Jacobi.

Entries become whole numbers x = floor(scale * c), so every sum is exact. The fit goes over each distinct vector
once: a first pass gives n and the sums S, a second the scatter of vectors centred at the whole numbers next to
S / n, whose small remainder is taken off exactly. Tasks add up what they hold; Spark adds up the tasks.

The centred scatter (dim x dim, whatever the rows) is factored by Cholesky with diagonal pivoting, and plane rotations from the
right make the columns of the triangular factor orthogonal (one-sided Jacobi on the factor itself; the scatter
isn't formed again). Rotated column norms squared, over n, are the eigenvalues of the covariance; normalised
columns are its components, to double precision even where eigenvalues are small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written

LARGEST = 1 << 53  # entries are held between plus and minus this
BLOCK = 4096  # rows of a matrix product


@dataclass
class Whitener:
    n: int
    sums: list[int]  # S, per dimension
    components: np.ndarray  # columns, by falling eigenvalue; only those above rounding
    eigenvalues: np.ndarray
    trace: float  # of the covariance


def pivoted_cholesky(a: np.ndarray, tol: float = 1e-14) -> tuple[np.ndarray, np.ndarray]:
    """(order, l) with a[order][:, order] = l @ l.T; l is lower trapezoidal, as wide as the rank."""
    a = np.array(a, dtype=float)
    d = len(a)
    order, l = np.arange(d), np.zeros((d, d))
    least = tol * max(np.diag(a).max(initial=0.0), 0.0) * d
    for k in range(d):
        p = k + int(np.argmax(np.diag(a)[k:]))
        if a[p, p] <= least:
            return order, l[:, :k]
        if p != k:
            a[[k, p]], l[[k, p]] = a[[p, k]], l[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
            order[[k, p]] = order[[p, k]]
        l[k, k] = a[k, k] ** 0.5
        l[k + 1 :, k] = a[k + 1 :, k] / l[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(l[k + 1 :, k], l[k + 1 :, k])
    return order, l


def rotated(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns of ``l`` turned by plane rotations until they are orthogonal. A sweep meets every pair of columns
    once, in rounds of disjoint pairs (a round-robin), so that a round is one array operation."""
    u = l.copy()
    r = u.shape[1]
    if r < 2:
        return u
    seats = list(range(r)) + ([None] if r % 2 else [])
    for _ in range(sweeps):
        off = 0.0
        for _ in range(len(seats) - 1):
            pairs = [(min(p), max(p)) for p in zip(seats[: len(seats) // 2], reversed(seats[len(seats) // 2 :])) if None not in p]
            i, j = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
            x, y = u[:, i], u[:, j]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            scale = np.sqrt(xx * yy)
            part = np.divide(np.abs(xy), scale, out=np.zeros_like(xy), where=scale > 0)
            off = max(off, part.max())
            turn = part > 1e-16
            z = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(z >= 0, 1.0, -1.0) / (np.abs(z) + np.hypot(1.0, z))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            u[:, i], u[:, j] = c * x - c * t * y, c * t * x + c * y
            seats.insert(1, seats.pop())
        if off < 4e-16 * max(4.0, r**0.5):
            break
    return u


def _whole(vec: str, scale: float):
    v = F.col(vec)
    held = lambda c: F.greatest(F.least(F.floor(F.greatest(F.least(c * scale, F.lit(2.0**60)), F.lit(-(2.0**60)))), F.lit(LARGEST)), F.lit(-LARGEST))
    return F.transform(v, lambda c: held(c.cast("double")))


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id and x (whole numbers) of the rows that can be used: the vector is there, and all its entries are, and
    are finite. Entries whose x is beyond +-2^53 are held there. Of several lengths the most frequent stays (the shortest
    of equally frequent ones); empty vectors go."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    rows = rows.select(F.col(id_col).alias("vec_id"), _whole(vec_col, scale).alias("x"))
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (most["d"] if most else 0))


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
    for b in batches:
        if len(b):
            yield np.stack(b["x"].to_numpy())


def _products(y: np.ndarray) -> np.ndarray:
    """y.T @ y of whole numbers, exactly: in doubles where all sums stay below 2^53, else in Python's integers."""
    top = int(np.abs(y).max(initial=0))
    rows = (1 << 53) // max(top * top, 1)
    if rows < 1:
        y = y.astype(object)
        return y.T @ y
    total = np.zeros((y.shape[1],) * 2, object)
    for s in range(0, len(y), min(rows, BLOCK)):
        part = y[s : s + min(rows, BLOCK)].astype(float)
        total = total + (part.T @ part).astype("int64").astype(object)
    return total


def moments(fit_rows: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and n^2 times the covariance of distinct rows x, as whole numbers."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(dim, object), 0
        for x in _blocks(batches):
            small = int(np.abs(x).max()) * len(x) < 1 << 62
            total, n = total + (x.sum(0).astype(object) if small else x.astype(object).sum(0)), n + len(x)
        if n:
            yield pd.DataFrame({"i": range(dim + 1), "s": [str(v) for v in (*total, n)]})

    def summed(df: DataFrame, *keys: str):
        return df.groupBy(*keys).agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()  # a number a cell

    got = {r["i"]: int(r["s"]) for r in summed(fit_rows.mapInPandas(sums, "i int, s string"), "i")}
    n, s = got.get(dim, 0), [got.get(i, 0) for i in range(dim)]
    if not n:
        return 0, s, []
    near = [(2 * v + n) // (2 * n) for v in s]  # the whole number next to the mean

    def scatter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((dim, dim), object), 0
        mid = np.array(near, dtype="int64")
        for x in _blocks(batches):
            total, n = total + _products(x - mid), n + len(x)
        if n:
            i, j = np.triu_indices(dim)
            yield pd.DataFrame({"i": i, "j": j, "s": [str(v) for v in total[i, j]]})

    rest = [v - n * m for v, m in zip(s, near)]
    cov = [[0] * dim for _ in range(dim)]
    for r in summed(fit_rows.mapInPandas(scatter, "i int, j int, s string"), "i", "j"):
        i, j = r["i"], r["j"]
        cov[i][j] = cov[j][i] = n * int(r["s"]) - rest[i] * rest[j]
    return n, s, cov


def fit(rows: DataFrame) -> tuple[Whitener, DataFrame]:
    """The whitener of ``rows`` (from ``whole_vectors``) and their distinct vectors. No rows: a whitener without components."""
    distinct = written(rows.select("x").distinct(), "whole-vectors")
    first = distinct.select(F.size("x").alias("d")).first()
    dim = first["d"] if first else 0
    n, s, cov = moments(distinct, dim)
    if not n:
        return Whitener(0, s, np.zeros((0, 0)), np.zeros(0), 0.0), distinct
    a = np.array([[v / n for v in row] for row in cov])  # the centred scatter, each entry rounded once
    order, l = pivoted_cholesky(a)
    u = rotated(l)
    norm2 = (u * u).sum(0)
    by = np.argsort(-norm2, kind="stable")
    by = by[norm2[by] > 0]
    comp = np.zeros((dim, len(by)))
    comp[order] = u[:, by] / np.sqrt(norm2[by])
    if len(by):
        comp *= np.where(comp[np.argmax(np.abs(comp), axis=0), np.arange(len(by))] < 0, -1.0, 1.0)
    return Whitener(n, s, comp, norm2[by] / n, sum(cov[i][i] for i in range(dim)) / n**2), distinct


def _projector(w: Whitener, top: int):
    n, s = w.n, w.sums
    axes = w.components[:, :top] / np.sqrt(w.eigenvalues[:top])
    largest = (1 << 62) // max(n, 1)

    def centred(x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        if np.abs(x).max(initial=0) < largest and max(map(abs, s), default=0) < 1 << 62:
            return x * n - np.array(s, dtype="int64")
        return x.astype(object) * n - np.array(s, dtype=object)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centred(x)
        return y, (y.astype(float) / n) @ axes

    return project


def identity_error(distinct: DataFrame, w: Whitener, top: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit rows minus the identity, from the rows themselves."""
    k = min(top, len(w.eigenvalues))
    if not k:
        return 0.0
    project = _projector(w, k)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k + 1, k + 1))
        for x in _blocks(batches):
            z = project(x)[1]
            z = np.hstack([z, np.ones((len(z), 1))])
            total += z.T @ z
        yield pd.DataFrame({"c": np.arange(total.size), "s": total.ravel()})

    got = np.zeros((k + 1) ** 2)
    for r in distinct.mapInPandas(sums, "c int, s double").groupBy("c").agg(F.sum("s").alias("s")).collect():
        got[r["c"]] = r["s"]
    got = got.reshape(k + 1, k + 1) / w.n
    return float(np.abs(got[:k, :k] - np.outer(got[:k, k], got[:k, k]) - np.eye(k)).max())


def whiten(rows: DataFrame, w: Whitener, top: int = 4) -> DataFrame:
    """A row per vector of ``rows`` (vec_id, x) and component (from 1, ``top`` at most): vec_id, component, n, deviation (sum over
    dimensions of (n x - S)^2; null where that is beyond 64 bits), whitened, explained (the component's share of the variance).

    Repeated ids and rows give rows of their own, a null id stays null. Components without variance can't be scaled and give no rows:
    fewer distinct vectors than components, or one vector only, or no rows at all."""
    k = min(top, len(w.eigenvalues))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    project = _projector(w, k)
    share = w.eigenvalues[:k] / w.trace

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            y, z = project(np.stack(b["x"].to_numpy()))
            if y.dtype == object or int(np.abs(y).max()) ** 2 * y.shape[1] >= 1 << 63:
                y = y.astype(object)
                dev = pd.Series([int(d) if d < 1 << 63 else None for d in (y * y).sum(1)], dtype="Int64")
            else:
                dev = pd.Series((y * y).sum(1), dtype="Int64")
            at = np.repeat(np.arange(len(b)), k)
            yield pd.DataFrame({"vec_id": b["vec_id"].astype("Int64").array.take(at), "component": np.tile(np.arange(1, k + 1), len(b)).astype("int32"),
                                "n": w.n, "deviation": dev.array.take(at), "whitened": z.ravel(), "explained": np.tile(share, len(b))})

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInPandas(put, schema)


def whitened_embeddings(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0, top: int = 4) -> DataFrame:
    """``whiten`` of all usable rows by their own fit, with the measured ``identity_error`` in every row."""
    rows = whole_vectors(vectors, id_col, vec_col, scale)
    w, distinct = fit(rows)
    return whiten(rows, w, top).withColumn("identity_error", F.lit(identity_error(distinct, w, top)))
