"""Invariants from the reference's reports, edge inputs, and the scale guards."""

import pytest
from pyspark.sql import functions as F

from conftest import MEDIUM, SMALL
from tessera.operators import bounded
from tessera.operators import profile as B
from tessera.operators import vectors as V
from tessera.plans import catalog
from tessera.streaming import incremental as T


def test_year_and_season_counts_sum_to_rows(spark):
    q = catalog.queries()
    years = q["b08_by_year"](spark, SMALL).agg(F.sum("count")).collect()[0][0]
    seasons = q["b12_by_season"](spark, SMALL).agg(F.sum("count")).collect()[0][0]
    n = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert years == seasons == n


def test_penetration_is_count_over_rows(spark):
    q = catalog.queries()
    rows = q["b03_market_penetration"](spark, SMALL).collect()
    total = q["s01_csv_scan"](spark, SMALL).count()
    for r in rows:
        assert r["share_pct"] == pytest.approx(round(r["count"] * 100.0 / total, 4))


def test_growth_one_year_is_insufficient(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-05-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = B.growth_metrics(df, "d").collect()[0]
    assert (r["average_growth_rate"], r["trend"], r["peak_year"]) == (0.0, "insufficient_data", 2020)


def test_growth_trends(spark):
    rows = [("2019-01-01",)] * 20 + [("2020-01-01",)] * 30
    df = spark.createDataFrame(rows, "d string").select(F.col("d").cast("date").alias("d"))
    r = B.growth_metrics(df, "d").collect()[0]
    assert (r["average_growth_rate"], r["trend"]) == (50.0, "growing")


def test_empty_vector_table(spark):
    empty = spark.createDataFrame([], "id long, embedding array<float>")
    r = V.dimension_stats(empty).collect()[0]
    assert (r["total_vectors"], r["average_dimension"]) == (0, 0.0)


def test_search_skips_other_lengths_and_negatives(spark):
    vecs = spark.createDataFrame(
        [(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.9, 0.1, 0.0, 0.0]), (3, [0.0, 0.0, 0.0, 0.0]), (4, [1.0, 0.0]),
         (5, [-1.0, 0.0, 0.0, 0.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([([1.0, 0.0, 0.0, 0.0],)], "query_vector array<double>")
    res = [r["id"] for r in V.search(vecs, q, k=10).collect()]
    assert res == [1, 2, 3]   # zero vector scores 0.0 (kept at min 0.0); other length and negative dropped


def test_search_is_the_same_for_any_number_of_blocks_and_queries(spark):
    e = spark.read.parquet(f"{SMALL}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    queries = e.where(F.col("id") < 30).select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    a = V.search_many(e, queries, k=3)
    b = V.search_many(e, queries, k=3, blocks=1)
    assert T.differs(a, b).count() == 0
    # more queries than the bound of the first round, which failed beyond it
    many = spark.range(20_100).select(F.col("id").alias("query_id"), F.array(F.lit(1.0), F.col("id") % 7).alias("query_vector"))
    few = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, embedding array<double>")
    assert V.search_many(few, many, k=1).count() == 20_100


def test_category_matrix_covers_unequal_lengths(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0], '{"category": "a"}'), (2, [1.0], '{"category": "b"}')],
                              "id long, embedding array<double>, metadata string")
    got = {(r[0], r[1]): r[2] for r in V.category_similarity_matrix(v).collect()}
    assert got == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}


def test_growth_trend_is_judged_before_rounding(spark):
    for last, trend, rate in ((105_003, "growing", 5.0), (94_997, "declining", -5.0), (105_000, "stable", 5.0)):
        df = spark.range(100_000 + last).select(F.when(F.col("id") < 100_000, F.lit("2019-01-01")).otherwise(F.lit("2020-01-01")).cast("date").alias("d"))
        r = B.growth_metrics(df, "d").collect()[0]
        assert (r["trend"], r["average_growth_rate"]) == (trend, rate)


def test_dense_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    out = bounded.dense_ids(df, ["k"], "n", offset=10).collect()
    pairs = sorted((r["k"], r["n"]) for r in out)
    assert [n for _, n in pairs] == list(range(11, 1011))


def test_stream_equals_batch(spark):
    q = catalog.queries()
    streamed = q["t06_stream_equals_batch"](spark, MEDIUM)
    events = spark.read.parquet(f"{MEDIUM}/events.parquet")
    batch = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("value_sum"))
    assert T.differs(streamed, batch).count() == 0


def test_all_null_column_and_empty_table(spark):
    from tessera.operators import quality as Q
    rows = [(1, None, "a@b.com", None, "2020-01-01", "+1 555"), (2, None, None, None, "bad", None)]
    df = spark.createDataFrame(rows, "idx long, customer_id string, email string, phone_1 string, "
                                     "subscription_date string, website string")
    nulls = {r["column_name"]: r["null_count"] for r in Q.null_counts(df).collect()}
    assert nulls["customer_id"] == 2 and nulls["idx"] == 0
    q = Q.quality_summary(df).collect()[0]
    assert (q["total_rows"], q["unique_customers"], q["duplicate_count"], q["invalid_dates"]) == (2, 0, 1, 1)
    assert q["valid_rows"] == 0   # a null id is invalid
    empty = spark.createDataFrame([], df.schema)
    e = Q.quality_summary(empty).collect()[0]
    assert (e["total_rows"], e["completeness_score"], e["validity_score"], e["consistency_score"]) == (0, 0.0, 0.0, 0.0)
