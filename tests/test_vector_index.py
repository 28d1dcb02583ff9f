"""Search through groups against the full search: clustered and odd vectors, ties, other lengths, empty sides."""

import random

import pytest

from tessera.operators import vector_index as X
from tessera.operators.vectors import search_many


def rows(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.similarity, 9)) for r in df.collect())


def clustered(n):
    r = random.Random(2)
    centres = [[r.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    return [(i, [x + r.gauss(0, 0.05) for x in centres[i % 12]]) for i in range(n)]


VECTORS, QUERIES = "id long, embedding array<double>", "query_id long, query_vector array<double>"


@pytest.mark.parametrize("k,least", [(5, 0.0), (3, 0.9), (700, -1.0)])
def test_same_rows_as_the_full_search(spark, k, least):
    data = clustered(600)
    data += [(1000 + i, data[3][1]) for i in range(200)]  # a third alike: ties by id
    data += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, 2.0]), (2004, [-x for x in data[0][1]])]
    vectors = spark.createDataFrame(data, VECTORS)
    queries = spark.createDataFrame([(1, data[0][1]), (2, data[3][1]), (3, [1.0, 2.0]), (4, [0.0] * 8), (5, None), (6, [1.0] * 3), (7, data[50][1])], QUERIES)
    index = X.build(vectors.repartition(3), pivots=40)
    found, share = X.search(index, queries, k, least)
    assert rows(found) == rows(search_many(vectors, queries, k, least))


def test_little_is_read_of_clustered_vectors(spark):
    data = clustered(1200)
    index = X.build(spark.createDataFrame(data, VECTORS), pivots=48)
    found, share = X.search(index, spark.createDataFrame([(1, data[0][1]), (2, data[5][1])], QUERIES), 5)
    s = share.first()
    assert s.vectors == 1200 and s.read < 600 and abs(s.share - s.read / 1200) < 1e-12
    assert rows(found) == rows(search_many(spark.createDataFrame(data, VECTORS), spark.createDataFrame([(1, data[0][1]), (2, data[5][1])], QUERIES), 5))


def test_empty_sides(spark):
    some, none = spark.createDataFrame(clustered(20), VECTORS), spark.createDataFrame([], VECTORS)
    q = spark.createDataFrame([(1, [1.0] * 8)], QUERIES)
    found, share = X.search(X.build(none), q)
    assert found.count() == 0 and share.first().vectors == 0
    assert X.search(X.build(some), q.where("false"))[0].count() == 0
