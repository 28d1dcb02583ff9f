"""Summaries of bounded size against exact counts: errors within their bound, merges in any order, hot keys, nulls, empty tables."""

import collections
import datetime as dt
import random

from pyspark.sql import functions as F

from tessera.operators import heavy_hitters as H
from tessera.operators import set_sketches as K
from tessera.session import shared_dir
from tessera.streaming.incremental import file_stream

PAIRS = "counter string, value string"


def pairs(seed, n):
    r = random.Random(seed)
    rows = [("a", "hot" if r.random() < 0.35 else f"v{int(r.paretovariate(0.6)) % 400}") for _ in range(n)]
    rows += [("b", f"u{i}") for i in range(60)] + [("c", "only")] * 3 + [("a", None), (None, "x")]
    r.shuffle(rows)
    return rows


def true_counts(rows):
    return collections.Counter((c, v) for c, v in rows if c and v)


def ranked(rows, k):
    by = collections.defaultdict(list)
    for (c, v), n in true_counts(rows).items():
        by[c].append((-n, v))
    return sorted((c, v, -n, i + 1) for c, x in by.items() for i, (n, v) in enumerate(sorted(x)[:k]))


def check(summary, rows, capacity):
    got = [tuple(r) for r in summary.collect()]
    error = {c: n for c, v, n in got if v is None}
    held = {(c, v): n for c, v, n in got if v is not None}
    true, total = true_counts(rows), collections.Counter(c for c, v in rows if c and v)
    assert all(n <= true[k] <= n + error[k[0]] for k, n in held.items())
    assert all(n <= error[c] for (c, v), n in true.items() if (c, v) not in held)
    assert all(e <= total[c] / (capacity + 1) for c, e in error.items())
    assert max(collections.Counter(c for c, _ in held).values()) <= capacity


def test_summaries_merge_within_the_bound(spark):
    parts = [pairs(i, 700) for i in range(4)]
    dfs = [spark.createDataFrame(p, PAIRS) for p in parts]
    each = [H.summarize(df, 12) for df in dfs]
    left = H.merge(H.merge(H.merge(each[0], each[1], 12), each[2], 12), each[3], 12)
    tree = H.merge(H.merge(each[3], each[0], 12), H.merge(each[2], each[1], 12), 12)
    rows = [x for p in parts for x in p]
    check(left, rows, 12)
    check(tree, rows, 12)


def test_top_is_exact_also_when_the_summary_is_too_small(spark):
    rows = pairs(9, 3000)
    df = spark.createDataFrame(rows, PAIRS)
    for capacity, sure in ((40, {"a", "c"}), (2, {"c"})):
        got = H.top(df, H.summarize(df, capacity), 5).collect()
        assert sorted((r.counter, r.value, r["count"], r["rank"]) for r in got) == ranked(rows, 5)
        assert sure <= {r.counter for r in got if r.certain} and "b" not in {r.counter for r in got if r.certain}
    none = spark.createDataFrame([], PAIRS)
    assert H.top(none, H.summarize(none, 5), 3).count() == 0


def test_streamed_summary_is_a_version_per_batch(spark):
    folder, path, ckpt = (shared_dir(spark, f"test-{x}") for x in ("in", "out", "ckpt"))
    parts = [pairs(20 + i, 300) for i in range(5)]
    for p in parts:
        spark.createDataFrame(p, PAIRS).coalesce(1).write.mode("append").parquet(folder)
    got = H.stream_summary(file_stream(spark, folder, spark.createDataFrame([], PAIRS).schema), 20, path, ckpt)
    check(got, [x for p in parts for x in p], 20)
    versions = spark.read.parquet(path).where("value is null and counter = 'c'").select("batch_id").distinct().count()
    assert versions == 5


def days(spark, sizes):
    """Per day the numbers lo..hi, a few of them thrice."""
    day = dt.date(2024, 1, 1)
    rows = None
    for i, (lo, hi) in enumerate(sizes):
        ids = spark.range(lo, hi).unionByName(spark.range(lo, min(hi, lo + 5))).unionByName(spark.range(lo, min(hi, lo + 5)))
        part = ids.select(F.lit(day + dt.timedelta(days=i)).alias("d"), F.col("id").alias("u"))
        rows = part if rows is None else rows.unionByName(part)
    odd = spark.createDataFrame([(None, 1), (day, None)], "d date, u long")
    return rows.unionByName(odd)


SIZES = [(0, 20_000), (10_000, 30_000), (30_000, 30_100), (0, 30_000), (90_000, 90_001)]


def sets(lags=3):
    out = []
    for j, (c, d) in enumerate(SIZES):
        for i in range(max(0, j - lags), j):
            a, b = SIZES[i]
            both = max(0, min(b, d) - max(a, c))
            out.append((i, j, b - a, d - c, b - a + d - c - both, both, b - a - both, d - c - both))
    return sorted(out)


def test_set_estimates_are_within_their_bound(spark):
    rows = days(spark, SIZES)
    start = dt.date(2024, 1, 1)
    exact = sorted(((r.earlier - start).days, (r.day - start).days, *tuple(r)[2:]) for r in K.overlaps(rows, "d", "u", 3).collect())
    assert exact == sets()
    for lg in (9, 12):
        sketches = K.daily_sketches(rows, "d", "u", lg)
        assert sketches.count() == len(SIZES)
        got = sorted(((r.earlier - start).days, (r.day - start).days, *tuple(r)[2:]) for r in K.estimates(sketches, 3, lg).collect())
        for g, x in zip(got, exact, strict=True):
            assert g[:2] == x[:2] and all(abs(p - q) <= g[8] for p, q in zip(g[2:8], x[2:8]))
        assert any(g[8] > 0 for g in got)


def test_sets_of_empty_tables(spark):
    none = spark.createDataFrame([], "d date, u long")
    assert K.overlaps(none, "d", "u").count() == 0 and K.estimates(K.daily_sketches(none, "d", "u")).count() == 0
