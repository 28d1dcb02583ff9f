"""Range joins: points in ranges, and overlaps of ranges, as equi-joins on bins.

A range belongs to a length class (a power of four above its length) and is entered in the few
bins of its class's grid that it touches; bins are a quarter of the class's length, so a range
has five of them at most and fills most of what it is entered in. A point is entered once per
class that occurs. The equi-join on (key, class, bin) therefore makes a number of candidates
in proportion to the matches where points are spread evenly, whatever the mix of lengths.

Two ranges meet in the grid of the longer one's class; of the bins they share, the one with the
later start makes the pair, so each pair is made once without a distinct. Large bins are ordinary
skewed join keys, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

FINE = 2  # bins per class length, as a power of two
STEP = 2  # classes are this many powers of two apart


def _grid(df: DataFrame, col: str) -> Column:
    """A whole number that rises with the column (not strictly): bins only have to keep the order, the match is tested on the values."""
    kind = df.schema[col].dataType
    if isinstance(kind, (TimestampType, TimestampNTZType, DateType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.floor(col).cast("long")


def _class(length: Column) -> Column:
    bits = F.when(length <= 0, 0).otherwise(F.length(F.bin(length)))
    return (F.ceil(bits / STEP) * STEP).cast("int")


def _shift(cls: Column) -> Column:
    return F.greatest(cls - FINE, F.lit(0))


def _bin(x: Column, cls: Column) -> Column:
    """The bin of ``x`` in a class's grid (an arithmetic shift: it rounds down below zero too)."""
    return F.call_function("shiftright", x, _shift(cls))


def _side(df: DataFrame, keys: Sequence[str], start: str, end: str, name: str) -> DataFrame:
    """key columns, the row's columns, and its range on the grid; ranges that are null or empty go, as do null keys."""
    ok = F.col(start).isNotNull() & (F.col(start) < F.col(end)) if start != end else F.col(start).isNotNull()
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    rows = df.where(ok).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(c).alias(f"_{name}_{c}") for c in df.columns],
                               _grid(df, start).alias(f"_lo_{name}"), _grid(df, end).alias(f"_hi_{name}"))
    length = F.coalesce(F.try_subtract(f"_hi_{name}", f"_lo_{name}"), F.lit((1 << 63) - 1))
    return rows.withColumn(f"_class_{name}", _class(length))


def _classes(side: DataFrame, name: str) -> Column:
    found = sorted(r[0] for r in side.select(f"_class_{name}").distinct().collect())  # at most 33
    return F.array(*map(F.lit, found)).cast("array<int>")


def _entries(side: DataFrame, name: str, classes: Column) -> DataFrame:
    """A row per class of ``classes`` (an array) and bin that the range touches there."""
    rows = side.withColumn("_class", F.explode(classes))
    return rows.withColumn("_bin", F.explode(F.sequence(_bin(F.col(f"_lo_{name}"), F.col("_class")), _bin(F.col(f"_hi_{name}"), F.col("_class")))))


def _named(joined: DataFrame, left: DataFrame, right: DataFrame, prefix: str) -> DataFrame:
    return joined.select(*[F.col(f"_l_{c}").alias(c) for c in left.columns], *[F.col(f"_r_{c}").alias(prefix + c) for c in right.columns])


def points_in_ranges(points: DataFrame, ranges: DataFrame, point: str, start: str, end: str, on: Sequence[str] = (), prefix: str = "range_") -> DataFrame:
    """A row per point and range with start <= point < end (and equal ``on``): the point's columns, the range's under ``prefix``.

    Numbers or times, ``on`` under the same names on both sides. Nulls match nothing, as do ranges whose end isn't after
    their start; repeated rows match each; empty sides give no rows.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    p, r = _side(points, on, point, point, "l"), _side(ranges, on, start, end, "r")
    p = p.withColumn("_class", F.explode(_classes(r, "r"))).withColumn("_bin", _bin(F.col("_lo_l"), F.col("_class")))
    r = _entries(r, "r", F.array("_class_r"))
    joined = p.join(r, [*keys, "_class", "_bin"]).where((F.col(f"_r_{start}") <= F.col(f"_l_{point}")) & (F.col(f"_l_{point}") < F.col(f"_r_{end}")))
    return _named(joined, points, ranges, prefix)


def overlaps(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str], on: Sequence[str] = (), prefix: str = "other_") -> DataFrame:
    """A row per pair of half-open ranges that share something (and equal ``on``): left's columns, right's under ``prefix``.

    Ranges that touch only at an end don't overlap. Nulls match nothing, as do empty or reversed ranges; repeated rows match each.
    """
    keys = [f"_k{i}" for i in range(len(on))]
    a, b = _side(left, on, *left_range, "l"), _side(right, on, *right_range, "r")
    above = lambda classes, own: F.filter(classes, lambda c: c > F.col(own))
    in_a, in_b = _classes(a, "l"), _classes(b, "r")
    first = _bin(F.greatest("_lo_l", "_lo_r"), F.col("_class"))
    share = (F.col(f"_l_{left_range[0]}") < F.col(f"_r_{right_range[1]}")) & (F.col(f"_r_{right_range[0]}") < F.col(f"_l_{left_range[1]}"))
    own_a = _entries(a, "l", F.array("_class_l"))
    own_b, up_b = _entries(b, "r", F.array("_class_r")), _entries(b, "r", above(in_a, "_class_r"))
    up_a = _entries(a, "l", above(in_b, "_class_l"))
    # shorter ranges go up to the longer one's grid; two that went up don't meet there
    met = own_a.join(own_b.unionByName(up_b), [*keys, "_class", "_bin"]).unionByName(up_a.join(own_b, [*keys, "_class", "_bin"]))
    return _named(met.where((F.col("_bin") == first) & share), left, right, prefix)
