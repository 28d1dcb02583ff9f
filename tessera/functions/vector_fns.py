"""Vector expressions over ``ARRAY<FLOAT|DOUBLE>`` columns.

All are built-in higher-order functions (JVM side, no Python per row). Elements are
widened to double before arithmetic, like the reference's Python floats.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a, b) -> Column:
    """Sum of element products over the positions of ``a`` (callers ensure equal lengths);
    indexed access avoids building an intermediate array per pair."""
    a, b = _c(a), _c(b)
    idx = F.sequence(F.lit(0), F.size(a) - 1)
    return F.when(F.size(a) == 0, F.lit(0.0)).otherwise(F.aggregate(
        idx, F.lit(0.0).cast("double"),
        lambda acc, i: acc + F.get(a, i).cast("double") * F.get(b, i).cast("double")))


def norm(a) -> Column:
    a = _c(a)
    return F.sqrt(
        F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine(a, b, norm_a=None, norm_b=None, strict: bool = True) -> Column:
    """Cosine similarity; a zero norm gives 0.0.

    ``strict``: unequal lengths raise (the reference's ``ValueError``); otherwise they give
    null, which a search then skips. Pass precomputed norms to avoid recomputing them per pair.
    """
    a, b = _c(a), _c(b)
    na = norm(a) if norm_a is None else _c(norm_a)
    nb = norm(b) if norm_b is None else _c(norm_b)
    sim = F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))
    mismatch = F.size(a) != F.size(b)
    if strict:
        return F.when(mismatch, F.raise_error(F.lit("Vectors must have same length")).cast("double")).otherwise(sim)
    return F.when(mismatch, F.lit(None).cast("double")).otherwise(sim)


def normalize(a) -> Column:
    """Unit length; a zero vector is returned unchanged (as doubles)."""
    a = _c(a)
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(
        F.transform(a, lambda x: x.cast("double") / n)
    )


def is_valid_embedding(a) -> Column:
    """Non-null, non-empty, every element a number (not null, not NaN)."""
    a = _c(a)
    return (
        a.isNotNull()
        & (F.size(a) > 0)
        & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x))
    )


def uniform01(seed: int, *keys) -> Column:
    """Deterministic U[0,1) from a hash of ``keys``: recomputes identically after a task retry."""
    h = F.xxhash64(F.lit(seed), *[_c(k) for k in keys])
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)
