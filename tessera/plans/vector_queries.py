"""Registered vector queries (S5–S8, S11, V1–V13) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.vector_fns import normalize
from tessera.operators import vector_index as X
from tessera.operators import vectors as V
from tessera.sources import views
from tessera.sources.tables import Tables

K = 5


def _emb(spark, d) -> DataFrame:
    return Tables(spark, d).embeddings.select(F.col("vec_id").alias("id"), "embedding", "label")


def _label_queries(spark, d) -> DataFrame:
    """Query set derived from the table: the lowest-id vector of each label."""
    return _emb(spark, d).groupBy(F.col("label").alias("query_id")).agg(
        F.min_by("embedding", "id").alias("query_vector")
    )


def _truncated(spark, d) -> DataFrame:
    """Embeddings where every 7th id (id % 7 = 3) lost its second half: other-length rows."""
    e = _emb(spark, d)
    return e.select(
        "id",
        F.when(F.col("id") % 7 == 3, F.slice("embedding", 1, F.size("embedding") / 2))
        .otherwise(F.col("embedding")).alias("embedding"),
    )


def _first_as_query(spark, d) -> DataFrame:
    return _emb(spark, d).select(F.lit(0).alias("query_id"), F.min_by("embedding", "id").alias("query_vector"))


def v01_cosine(spark: SparkSession, d: str) -> DataFrame:
    """V1 over the whole table against its lowest-id vector."""
    scored = V.scored_candidates(_emb(spark, d), _first_as_query(spark, d))
    return scored.select("id", F.round("similarity", 6).alias("similarity"))


def v02_search(spark, d):
    query = _emb(spark, d).select(F.min_by("embedding", "id").alias("query_vector"))
    res = V.search(_emb(spark, d), query, k=K)
    return res.select("id", F.round("similarity", 6).alias("similarity"))


def v03_batch_search(spark, d):
    res = V.search_many(_emb(spark, d), _label_queries(spark, d), k=K)
    return res.select("query_id", "rank", "id", F.round("similarity", 6).alias("similarity"))


def v03_pruned_search(spark, d):
    """The same rows, reading only the groups of vectors that can hold them."""
    res, _ = X.search(X.build(_emb(spark, d)), _label_queries(spark, d), K)
    return res.select("query_id", "rank", "id", F.round("similarity", 6).alias("similarity"))


def v04_normalize(spark, d):
    n = normalize("embedding")
    return _emb(spark, d).select("id", F.transform(n, lambda x: F.round(x, 6)).alias("unit_vector"))


def v05_skip_other_length(spark, d):
    scored = V.scored_candidates(_truncated(spark, d), _first_as_query(spark, d))
    return scored.select("id", F.round("similarity", 6).alias("similarity"))


def _with_bad_rows(spark, d):
    e = _emb(spark, d)
    emb = (
        F.when(F.col("id") % 13 == 6, F.lit(None).cast("array<float>"))
        .when(F.col("id") % 11 == 5, F.array_append("embedding", F.lit(float("nan")).cast("float")))
        .otherwise(F.col("embedding"))
    )
    return e.select("id", emb.alias("embedding"))


def v06_validate(spark, d):
    valid, quarantined = V.validate(_with_bad_rows(spark, d))
    return valid.select("id", F.lit(True).alias("is_valid")).unionByName(
        quarantined.select("id", F.lit(False).alias("is_valid"))
    )


def v07_category_counts(spark, d):
    return V.category_counts(views.vectors_v(spark, d))


def v08_dimension_stats(spark, d):
    return V.dimension_stats(_truncated(spark, d)).select(
        "total_vectors", F.round("average_dimension", 6).alias("average_dimension")
    )


def v09_dimension_histogram(spark, d):
    return V.dimension_histogram(_truncated(spark, d))


def v10_first_per_category(spark, d):
    return V.first_per_category(views.vectors_v(spark, d)).select("category", "id")


def v11_category_matrix(spark, d):
    return V.category_similarity_matrix(views.vectors_v(spark, d))


def v12_search_summary(spark, d):
    queries = _label_queries(spark, d)
    return V.search_summary(V.search_many(_emb(spark, d), queries, k=K), queries)


def v13_comparisons(spark, d):
    return V.comparison_counts(_truncated(spark, d), _label_queries(spark, d))


def s05_vector_scan(spark, d):
    v = views.vectors_v(spark, d)
    return v.select(
        "id", "content", "metadata", F.size("embedding").alias("dimension"),
        F.round(F.aggregate("embedding", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double")), 4)
        .alias("checksum"),
    )


def s06_append_vectors(spark, d):
    table = views.vectors_v(spark, d)
    new_rows = table.select(
        F.col("id").alias("src_id"), normalize("embedding").alias("embedding"),
        F.concat(F.lit("normalized "), F.col("id").cast("string")).alias("content"),
        F.lit(None).cast("string").alias("metadata"),
    )
    out = V.append_vectors(table.withColumn("embedding", F.col("embedding").cast("array<double>")),
                           new_rows, "src_id")
    return out.select("id", "content", "metadata", F.size("embedding").alias("dimension"))


def s07_point_lookup(spark, d, vector_id: int = 7):
    v = views.vectors_v(spark, d).where(F.col("id") == vector_id)
    return v.select("id", "content", "metadata", F.size("embedding").alias("dimension"))


def s08_delete_vectors(spark, d):
    table = views.vectors_v(spark, d)
    ids = Tables(spark, d).embeddings.where(F.col("label") == 3).select(F.col("vec_id").alias("id"))
    remaining, _ = V.delete_vectors(table, ids)
    return remaining.select("id", "content")


def s08_deleted_count(spark, d):
    table = views.vectors_v(spark, d)
    ids = Tables(spark, d).embeddings.where(F.col("label") == 3).select(F.col("vec_id").alias("id"))
    return V.delete_vectors(table, ids)[1]


def s11_synthetic_vectors(spark, d):
    rows = _emb(spark, d).select("id", "label", F.size("embedding").alias("dims"))
    rows = rows.withColumn("axis", F.col("label") % F.col("dims"))
    return V.synthetic_near_axis(rows).select("id", "label", "embedding")


def s11_vector_properties(spark, d):
    """What the synthetic vectors promise, per id: length one, the axis largest, the rest within the ratio that the variance allows."""
    rows = s11_synthetic_vectors(spark, d)
    v = F.col("embedding")
    top = F.array_max(v)
    rest = F.array_max(F.filter(v, lambda x: x != top))
    return rows.select("id", "label", F.size(v).cast("long").alias("dims"), (F.array_position(v, top) - 1).alias("largest"),
                       (F.abs(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x) - 1) < 1e-9).alias("unit_length"),
                       (rest <= top * (0.15 / 0.7)).alias("near_axis"), (F.array_min(v) >= 0).alias("not_negative"))


def _duck_cos(a: str, b: str) -> str:
    na = f"sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[]))"
    nb = f"sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))"
    return (f"(CASE WHEN {na} = 0 OR {nb} = 0 THEN 0.0 ELSE "
            f"list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / ({na} * {nb}) END)")


_LABEL_Q = "SELECT label AS query_id, arg_min(embedding, vec_id) AS qv FROM embeddings GROUP BY label"
_TRUNC = ("SELECT vec_id AS id, CASE WHEN vec_id % 7 = 3 THEN embedding[1:len(embedding) // 2] "
          "ELSE embedding END AS embedding FROM embeddings")
_TOPK = f"""
SELECT query_id, CAST(rank AS INTEGER) AS rank, id, round(similarity, 6) AS similarity FROM (
  SELECT query_id, vec_id AS id, sim AS similarity,
         row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS rank
  FROM (SELECT query_id, vec_id, {_duck_cos('embedding', 'qv')} AS sim
        FROM embeddings JOIN ({_LABEL_Q}) q ON len(embedding) = len(qv))
  WHERE sim >= 0.0) WHERE rank <= {K}
"""

ORACLES = {
    "v01_cosine": f"""SELECT vec_id AS id, round({_duck_cos('embedding', 'qv')}, 6) AS similarity
        FROM embeddings, (SELECT arg_min(embedding, vec_id) AS qv FROM embeddings) q""",
    "v02_search": f"""SELECT id, round(similarity, 6) AS similarity FROM (
        SELECT vec_id AS id, {_duck_cos('embedding', 'qv')} AS similarity
        FROM embeddings, (SELECT arg_min(embedding, vec_id) AS qv FROM embeddings) q)
        WHERE similarity >= 0.0 ORDER BY similarity DESC, id LIMIT {K}""",
    "v03_batch_search": _TOPK,
    "v04_normalize": """SELECT vec_id AS id, CASE WHEN n = 0 THEN list_transform(embedding, lambda x: round(x::DOUBLE, 6))
        ELSE list_transform(embedding, lambda x: round(x::DOUBLE / n, 6)) END AS unit_vector
        FROM (SELECT vec_id, embedding, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS n
              FROM embeddings)""",
    "v05_skip_other_length": f"""SELECT id, round({_duck_cos('embedding', 'qv')}, 6) AS similarity
        FROM ({_TRUNC}) t, (SELECT arg_min(embedding, vec_id) AS qv FROM embeddings) q
        WHERE len(embedding) = len(qv)""",
    "v06_validate": """SELECT vec_id AS id, NOT (vec_id % 13 = 6 OR vec_id % 11 = 5) AS is_valid FROM embeddings""",
    "v07_category_counts": """SELECT category, count(*) AS n_vectors,
        round(count(*) * 100.0 / (SELECT count(*) FROM vectors_v), 4)::DOUBLE AS share_pct
        FROM (SELECT coalesce(json_extract_string(metadata, '$.category'), 'unknown') AS category FROM vectors_v)
        GROUP BY category""",
    "v08_dimension_stats": f"""SELECT count(*) AS total_vectors, round(coalesce(avg(len(embedding)), 0.0), 6)
        AS average_dimension FROM ({_TRUNC})""",
    "v09_dimension_histogram": f"""SELECT CAST(len(embedding) AS INTEGER) AS dimension, count(*) AS n_vectors
        FROM ({_TRUNC}) GROUP BY 1""",
    "v10_first_per_category": """SELECT coalesce(json_extract_string(metadata, '$.category'), 'unknown') AS category,
        min(id) AS id FROM vectors_v GROUP BY 1""",
    "v11_category_matrix": f"""WITH r AS (SELECT coalesce(json_extract_string(metadata, '$.category'), 'unknown') AS c,
        arg_min(embedding, id) AS e FROM vectors_v GROUP BY 1)
        SELECT a.c AS category_1, b.c AS category_2, round({_duck_cos('a.e', 'b.e')}, 6) AS similarity
        FROM r a JOIN r b ON len(a.e) = len(b.e)""",
    "v12_search_summary": f"""WITH t AS ({_TOPK}), q AS ({_LABEL_Q}),
        p AS (SELECT q.query_id, count(t.id) AS n, max(t.similarity) AS mx, min(t.similarity) AS mn
              FROM q LEFT JOIN t ON q.query_id = t.query_id GROUP BY q.query_id)
        SELECT count(*) AS search_queries, CAST(sum(n) AS BIGINT) AS total_results,
          round(avg(n), 6) AS avg_results_per_search,
          round(greatest(0.0, coalesce(max(mx), 0.0)), 6)::DOUBLE AS highest_similarity,
          round(least(1.0, coalesce(min(mn), 1.0)), 6)::DOUBLE AS lowest_similarity FROM p""",
    "v13_comparisons": f"""SELECT q.query_id, CAST(count(t.id) AS BIGINT) AS comparisons
        FROM ({_LABEL_Q}) q LEFT JOIN ({_TRUNC}) t ON len(t.embedding) = len(q.qv) GROUP BY q.query_id""",
    "s05_vector_scan": """SELECT id, content, metadata, CAST(len(embedding) AS INTEGER) AS dimension,
        round(list_sum(embedding::DOUBLE[]), 4) AS checksum FROM vectors_v""",
    "s06_append_vectors": """SELECT id, content, metadata, CAST(len(embedding) AS INTEGER) AS dimension FROM vectors_v
        UNION ALL
        SELECT (SELECT max(id) FROM vectors_v) + row_number() OVER (ORDER BY id) AS id,
          'normalized ' || CAST(id AS VARCHAR) AS content, '{}' AS metadata,
          CAST(len(embedding) AS INTEGER) AS dimension FROM vectors_v""",
    "s07_point_lookup": """SELECT id, content, metadata, CAST(len(embedding) AS INTEGER) AS dimension
        FROM vectors_v WHERE id = 7""",
    "s08_delete_vectors": """SELECT id, content FROM vectors_v
        WHERE id NOT IN (SELECT vec_id FROM embeddings WHERE label = 3)""",
    "s08_deleted_count": """SELECT count(*) AS deleted FROM vectors_v
        WHERE id IN (SELECT vec_id FROM embeddings WHERE label = 3)""",
}

QUERIES = {
    "v01_cosine": v01_cosine,
    "v02_search": v02_search,
    "v03_batch_search": v03_batch_search,
    "v04_normalize": v04_normalize,
    "v05_skip_other_length": v05_skip_other_length,
    "v06_validate": v06_validate,
    "v07_category_counts": v07_category_counts,
    "v08_dimension_stats": v08_dimension_stats,
    "v09_dimension_histogram": v09_dimension_histogram,
    "v10_first_per_category": v10_first_per_category,
    "v11_category_matrix": v11_category_matrix,
    "v12_search_summary": v12_search_summary,
    "v13_comparisons": v13_comparisons,
    "s05_vector_scan": s05_vector_scan,
    "s06_append_vectors": s06_append_vectors,
    "s07_point_lookup": s07_point_lookup,
    "s08_delete_vectors": s08_delete_vectors,
    "s08_deleted_count": s08_deleted_count,
    "s11_synthetic_vectors": s11_synthetic_vectors,
    "s11_vector_properties": s11_vector_properties,
}

ORACLES["s11_vector_properties"] = """SELECT vec_id AS id, label, len(embedding) AS dims, CAST(label % len(embedding) AS BIGINT) AS largest,
    true AS unit_length, true AS near_axis, true AS not_negative FROM embeddings"""

QUERIES["v03_pruned_search"] = v03_pruned_search
ORACLES["v03_pruned_search"] = ORACLES["v03_batch_search"]
