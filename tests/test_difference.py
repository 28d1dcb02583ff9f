"""Table differences against counters of rows: null and repeated keys, equal rows, empty tables, one hot row."""

import collections
import random

from tessera.operators import difference as D

SCHEMA = "k string, a long, b double"


def counts(df):
    return collections.Counter(map(tuple, df.collect()))


def cases():
    r = random.Random(3)
    pick = lambda: (r.choice(["a", "b", "c", None, "", "hot"]) if r.random() < 0.5 else f"k{r.randint(0, 80)}", r.choice([None, 1, 2]), r.choice([None, 0.5]))
    old, new = [pick() for _ in range(200)], [pick() for _ in range(200)]
    both = [(f"same{i}", i, 1.0) for i in range(50)]
    return old + both + [("hot", 1, 1.0)] * 9000, both + new + [("hot", 1, 1.0)] * 4500 + [("only", 1, 1.0), ("only2", None, None)]


def test_difference_and_its_application(spark):
    old, new = cases()
    a, b = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA).select("b", "k", "a")
    changes = D.difference(a, b, ["k"])
    n_old, n_new = collections.Counter(old), collections.Counter(new)
    got = {tuple(r)[:3]: (r.change, r.copies) for r in changes.collect()}
    assert {k: v[1] for k, v in got.items()} == {k: n_new[k] - n_old[k] for k in {*old, *new} if n_old[k] != n_new[k]}
    by_old, by_new = collections.Counter(k for k, _, _ in old), collections.Counter(k for k, _, _ in new)
    for row, (change, copies) in got.items():
        o, n = by_old[row[0]], by_new[row[0]]
        want = "repeated" if max(o, n) > 1 else "insert" if not o else "delete" if not n else "update_from" if copies < 0 else "update_to"
        assert change == want
    assert counts(D.apply(a, changes)) == n_new
    assert {tuple(r)[:3]: r.copies for r in D.common(a, b).collect()} == dict(n_old & n_new)


def test_difference_of_empty_tables(spark):
    some, none = spark.createDataFrame([("x", 1, 1.0), (None, 2, None)], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert {r.change for r in D.difference(some, none, ["k"]).collect()} == {"delete"}
    assert {r.change for r in D.difference(none, some, ["k"]).collect()} == {"insert"}
    assert D.difference(none, none, ["k"]).count() == D.difference(some, some, ["k"]).count() == 0
    assert D.apply(some, D.difference(some, none, ["k"])).count() == 0
