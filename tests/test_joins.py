"""As-of and range joins against brute force: nulls, ties, repeated rows, empty tables, one hot key."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.operators import asof, ranges


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


LEFT, RIGHT = "k string, t long, n long", "k string, u long, v string"


def asof_cases(seed, n):
    r = random.Random(seed)
    key = lambda: "hot" if r.random() < 0.4 else r.choice(["a", "b", None, ""])
    time = lambda: None if r.random() < 0.05 else 500 if r.random() < 0.3 else r.randint(0, 1000)
    left = [(key(), time(), i) for i in range(n)]
    right = [(key(), time(), f"v{r.randint(0, 50)}") for _ in range(n)]
    return left + left[:20], right + right[:20]


def brute_asof(left, right, backward, equal, tolerance):
    out = []
    for k, t, n in left:
        fits = [(u, v) for q, u, v in right if None not in (k, t, q, u) and q == k and (u < t if backward else u > t) | (equal and u == t)
                and abs(t - u) <= tolerance]
        best = (max(fits) if backward else min(fits, key=lambda f: (f[0], [-ord(c) for c in f[1]]))) if fits else (None, None)
        if fits and not backward:  # the last of those at the nearest time
            best = max(f for f in fits if f[0] == best[0])
        out.append((k, t, n, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("direction,equal,tolerance", [("backward", False, 10**9), ("backward", True, 30), ("forward", False, 30), ("forward", True, 10**9)])
def test_asof_equals_brute_force(spark, direction, equal, tolerance):
    left, right = asof_cases(1, 300)
    got = asof.asof_join(spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(2), ["k"], "t", "u",
                         allow_equal=equal, direction=direction, tolerance=F.lit(tolerance), partitions=7)
    assert got.columns == ["k", "t", "n", "u", "v"]
    assert rows(got) == brute_asof(left, right, direction == "backward", equal, tolerance)


def test_asof_without_keys_and_with_empty_sides(spark):
    left, right = spark.createDataFrame([("a", 5, 1), ("b", 1, 2)], LEFT), spark.createDataFrame([("c", 3, "x")], RIGHT)
    got = asof.asof_join(left, right, [], "t", "u", prefix="r_")
    assert rows(got) == [("a", 5, 1, "c", 3, "x"), ("b", 1, 2, None, None, None)]
    assert rows(asof.asof_join(left, right.where("false"), ["k"], "t", "u")) == [("a", 5, 1, None, None), ("b", 1, 2, None, None)]
    assert rows(asof.asof_join(left.where("false"), right, ["k"], "t", "u")) == []
    with pytest.raises(ValueError):
        asof.asof_join(left, right.withColumn("n", F.lit(1)), ["k"], "t", "u")


def test_asof_spreads_one_instant_of_one_key(spark, monkeypatch):
    """Half of all rows share key and time: no task holds more than a few parts of them."""
    n = 4000
    left = spark.range(n).select(F.lit("hot").alias("k"), F.lit(7).cast("long").alias("t"), F.col("id").alias("n"))
    right = spark.range(n).select(F.lit("hot").alias("k"), F.lit(6).cast("long").alias("u"), F.concat(F.lit("v"), "id").alias("v"))
    sizes = []
    plain = type(left).checkpoint

    def seen(self, *a, **kw):
        out = plain(self, *a, **kw)
        sizes.extend(r["n"] for r in out.groupBy(F.shiftright("at", 33).alias("p")).agg(F.count("*").alias("n")).collect())
        return out

    monkeypatch.setattr(type(left), "checkpoint", seen)
    got = asof.asof_join(left, right, ["k"], "t", "u", partitions=16)
    assert got.where("v = 'v999'").count() == got.count() == n
    assert len(sizes) >= 12 and max(sizes) < 2 * n * 3 / 16


def range_cases(seed, n):
    r = random.Random(seed)
    point = lambda: None if r.random() < 0.05 else 0.0 if r.random() < 0.3 else round(r.uniform(-300, 300), 2)
    key = lambda: "hot" if r.random() < 0.4 else r.choice(["a", "b", None])

    def span():
        a = point()
        return a, None if a is None or r.random() < 0.05 else a + r.choice([0, -1, 0.01, 0.5, 3, 3, 40, 500])

    points = [(key(), point(), i) for i in range(n)]
    spans = [(key(), *span(), i) for i in range(n)]
    return points + points[:9], spans + spans[:9]


POINT, SPAN = "k string, p double, i long", "k string, a double, b double, j long"


@pytest.mark.parametrize("on", [[], ["k"]])
def test_points_in_ranges_equal_brute_force(spark, on):
    points, spans = range_cases(2, 150)
    got = ranges.points_in_ranges(spark.createDataFrame(points, POINT), spark.createDataFrame(spans, SPAN), "p", "a", "b", on)
    want = [(*x, *y) for x in points for y in spans if None not in (x[1], y[1], y[2]) and y[1] <= x[1] < y[2]
            and (not on or (x[0] is not None and x[0] == y[0]))]
    assert rows(got) == sorted(want, key=str)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop", plan)


@pytest.mark.parametrize("on", [[], ["k"]])
def test_overlaps_equal_brute_force(spark, on):
    _, spans = range_cases(3, 120)
    _, others = range_cases(4, 90)
    a, b = spark.createDataFrame(spans, SPAN), spark.createDataFrame(others, SPAN)
    full = lambda y: None not in y[1:3] and y[1] < y[2]
    for left, right, x, y in ((a, b, spans, others), (a, a, spans, spans)):
        got = ranges.overlaps(left, right, ("a", "b"), ("a", "b"), on)
        want = [(*p, *q) for p in x for q in y if full(p) and full(q) and p[1] < q[2] and q[1] < p[2] and (not on or (p[0] is not None and p[0] == q[0]))]
        assert rows(got) == sorted(want, key=str)
        assert not re.search("Cartesian|NestedLoop", got._jdf.queryExecution().executedPlan().toString())


def test_ranges_of_empty_sides_and_far_values(spark):
    p, s = spark.createDataFrame([("a", 1.0, 1)], POINT), spark.createDataFrame([("a", 0.0, 2.0, 5)], SPAN)
    assert ranges.points_in_ranges(p.where("false"), s, "p", "a", "b").count() == ranges.points_in_ranges(p, s.where("false"), "p", "a", "b").count() == 0
    assert ranges.overlaps(s, s.where("false"), ("a", "b"), ("a", "b")).count() == 0
    wide = spark.createDataFrame([("a", -1e300, 1e300, 1), ("a", float("-inf"), float("inf"), 2)], SPAN)
    assert ranges.points_in_ranges(p, wide, "p", "a", "b").count() == 2
    assert ranges.overlaps(s, wide, ("a", "b"), ("a", "b")).count() == 2


def test_candidates_follow_the_matches(spark):
    """Evenly spread points in ranges of mixed lengths: the bins' join makes few rows beyond the matches."""
    n = 3000
    points = spark.range(n).select((F.col("id") * 37 % 100_000).alias("p"), "id")
    spans = spark.range(n).select((F.col("id") * 53 % 100_000).alias("a"), F.col("id").alias("j"))
    spans = spans.withColumn("b", F.col("a") + F.when(F.col("j") % 50 == 0, 20_000).otherwise(30 + F.col("j") % 100))
    matches = ranges.points_in_ranges(points, spans, "p", "a", "b").count()
    r = ranges._side(spans, [], "a", "b", "r")
    p = ranges._side(points, [], "p", "p", "l").withColumn("_class", F.explode(ranges._classes(r, "r"))).withColumn("_bin", ranges._bin(F.col("_lo_l"), F.col("_class")))
    candidates = p.join(ranges._entries(r, "r", F.array("_class_r")), ["_class", "_bin"]).count()
    assert matches > n and candidates < 3 * matches
