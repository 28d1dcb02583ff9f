"""R3 on groups whose candidate numbers are null or repeat."""

from tessera.operators.receipts import best_candidate


def test_one_longest_candidate_of_each_group(spark):
    rows = [("a", None, " longest "), ("a", 1, "short"), ("b", 1, "x"), ("b", 1, "longer"), ("c", 2, "tie"), ("c", 1, "eit"),
            (None, 3, "n"), ("d", 1, None), ("e", 1, "same"), ("e", 1, "same"), ("f", None, "one"), ("f", 4, "two")]
    got = best_candidate(spark.createDataFrame(rows, "grp string, candidate_no int, text string"), "grp").collect()
    assert {tuple(r) for r in got} == {("a", None, " longest "), ("b", 1, "longer"), ("c", 1, "eit"), (None, 3, "n"), ("d", 1, None),
                                       ("e", 1, "same"), ("f", 4, "two")}
    assert len(got) == 7
