"""Containment of names through sorted suffixes against plain substring tests."""

import random

import pytest

from tessera.operators.stores import contains_match


@pytest.mark.parametrize("lowest", [False, True])
def test_contains_equals_substring_tests(spark, lowest):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abé😀 x") for _ in range(r.randint(1, 4)))
    names = [(i, word() + word()) for i in range(60)] + [(100 + i, "Hot Mart") for i in range(40)] + [(200, None), (201, ""), (202, "Ünï CODE"), (0, "aab")]
    norms = [word() for _ in range(60)] + ["hot mart", "mart", "t", "hot", "ünï", "code", "zzz", "", None, "a", "aa", "aab", "hot mart east of everything"] * 2
    stores = spark.createDataFrame(names, "id long, name string")
    wanted = spark.createDataFrame([(n,) for n in norms], "norm string")
    pairs = {(n, i) for n in norms if n for i, s in names if s and n in s.lower()}
    if lowest:
        pairs = {(n, min(i for m, i in pairs if m == n)) for n, _ in pairs}
    got = [tuple(x) for x in contains_match(stores, wanted, lowest=lowest).collect()]
    assert len(got) == len(set(got)) and set(got) == pairs


def test_contains_of_empty_sides(spark):
    stores = spark.createDataFrame([(1, "a mart")], "id long, name string")
    norms = spark.createDataFrame([("mart",)], "norm string")
    assert contains_match(stores.where("false"), norms).count() == contains_match(stores, norms.where("false")).count() == 0
