"""Exact cosine search and statistics over embedding tables.

Search plan: vectors are read once, with norms computed once per vector, and dealt to blocks;
each block meets the query set on vector length (an equi-join: vectors of another length are
skipped, V5) and keeps its own top-k per query (``WindowGroupLimit`` before the shuffle), so
queries x k x blocks rows move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.vector_fns import cosine, is_valid_embedding, norm, normalize, uniform01
from tessera.operators.bounded import dense_ids

def _prepare_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    return vectors.select(
        F.col(id_col).alias("id"),
        F.col(vec_col).alias("_v"),
        F.size(vec_col).alias("_dim"),
        norm(vec_col).alias("_vn"),
    )


def _prepare_queries(queries: DataFrame, qid_col: str, qvec_col: str) -> DataFrame:
    return queries.select(
        F.col(qid_col).alias("query_id"),
        F.col(qvec_col).alias("_q"),
        F.size(qvec_col).alias("_dim"),
        norm(qvec_col).alias("_qn"),
    )


def _blocks(df: DataFrame, blocks: int | None) -> int:
    return blocks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def scored_candidates(vectors: DataFrame, queries: DataFrame, id_col="id", vec_col="embedding",
                      qid_col="query_id", qvec_col="query_vector", blocks: int | None = None) -> DataFrame:
    """(query_id, block, id, similarity) of a stated query set against all vectors of the same length.

    Vectors are dealt to blocks by a hash of their id and each block gets the queries once, so
    the vectors are read once, whatever the number of queries, and the optimizer chooses how
    the query side travels."""
    n = _blocks(vectors, blocks)
    v = _prepare_vectors(vectors, id_col, vec_col).withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    q = _prepare_queries(queries, qid_col, qvec_col).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return v.join(q, ["block", "_dim"]).select(
        "query_id", "block", "id", cosine("_v", "_q", "_vn", "_qn", strict=False).alias("similarity"))


def search_many(vectors: DataFrame, queries: DataFrame, k: int = 5, min_similarity: float = 0.0,
                id_col="id", vec_col="embedding", qid_col="query_id", qvec_col="query_vector",
                blocks: int | None = None) -> DataFrame:
    """V3: exact top-k per query (similarity desc, id asc), ``similarity >= min_similarity``: the best k of
    each block (limited before they move), then of all blocks. Any number of queries."""
    scored = scored_candidates(vectors, queries, id_col, vec_col, qid_col, qvec_col, blocks)
    best = [F.desc("similarity"), F.asc("id")]
    scored = scored.where(F.col("similarity") >= F.lit(min_similarity))
    for keys in (["block", "query_id"], ["query_id"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best))).where(F.col("rank") <= k)
    return scored.select("query_id", "rank", "id", "similarity")


def search(vectors: DataFrame, query: DataFrame, k: int = 5, min_similarity: float = 0.0,
           id_col="id", vec_col="embedding", qvec_col="query_vector") -> DataFrame:
    """V2: one query vector (a one-row DataFrame) → top-k rows, ordered."""
    q = query.select(F.lit(0).alias("query_id"), F.col(qvec_col).alias("query_vector"))
    scored = scored_candidates(vectors, q, id_col, vec_col)
    return (
        scored.where(F.col("similarity") >= F.lit(min_similarity))
        .orderBy(F.desc("similarity"), F.asc("id"))
        .limit(k)
        .select("id", "similarity")
    )


def validate(vectors: DataFrame, vec_col="embedding") -> tuple[DataFrame, DataFrame]:
    """V6: (valid, quarantined)."""
    ok = is_valid_embedding(vec_col)
    return vectors.where(ok), vectors.where(~ok | F.col(vec_col).isNull())


def category_of(metadata_col="metadata"):
    """V7: JSON ``category``; null, missing or unparsable metadata → ``unknown``."""
    return F.coalesce(F.get_json_object(F.col(metadata_col), "$.category"), F.lit("unknown"))


def category_counts(vectors: DataFrame, metadata_col="metadata") -> DataFrame:
    """V7: count per category and share of all vectors (total as a scalar subquery)."""
    total = vectors.select(F.count(F.lit(1))).scalar()
    return (
        vectors.groupBy(category_of(metadata_col).alias("category"))
        .agg(F.count(F.lit(1)).alias("n_vectors"))
        .withColumn("share_pct", F.round(F.col("n_vectors") * 100.0 / total, 4))
    )


def dimension_stats(vectors: DataFrame, vec_col="embedding") -> DataFrame:
    """V8: total vectors and average dimension; an empty table gives 0 and 0.0."""
    return vectors.agg(
        F.count(F.lit(1)).alias("total_vectors"),
        F.coalesce(F.avg(F.size(vec_col)), F.lit(0.0)).alias("average_dimension"),
    )


def dimension_histogram(vectors: DataFrame, vec_col="embedding") -> DataFrame:
    """V9."""
    return vectors.groupBy(F.size(vec_col).alias("dimension")).agg(F.count(F.lit(1)).alias("n_vectors"))


def first_per_category(vectors: DataFrame, id_col="id", vec_col="embedding", metadata_col="metadata",
                       within_first: int | None = None) -> DataFrame:
    """Lowest-id vector of each category (optionally among the first ``within_first`` ids)."""
    src = vectors
    if within_first is not None:
        src = src.orderBy(id_col).limit(within_first)
    return src.groupBy(category_of(metadata_col).alias("category")).agg(
        F.min(id_col).alias("id"), F.min_by(F.col(vec_col), F.col(id_col)).alias("embedding")
    )


def category_similarity_matrix(vectors: DataFrame, id_col="id", vec_col="embedding",
                               metadata_col="metadata", wide: bool = False, blocks: int | None = None) -> DataFrame:
    """Cosine between the representatives of every pair of categories (diagonal included); NULL
    between vectors of different lengths.

    The result has a row per pair; the representatives (one row a category) are dealt to blocks,
    and each block gets the others once. Long form (category_1, category_2, similarity);
    ``wide`` pivots it.
    """
    n = _blocks(vectors, blocks)
    reps = first_per_category(vectors, id_col, vec_col, metadata_col)
    left = reps.select(F.col("category").alias("category_1"), F.col("embedding").alias("_a"),
                       F.pmod(F.xxhash64("category"), F.lit(n)).cast("int").alias("block"))
    right = reps.select(F.col("category").alias("category_2"), F.col("embedding").alias("_b"),
                        F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"))
    long = left.join(right, "block").select(
        "category_1", "category_2", F.when(F.size("_a") == F.size("_b"), F.round(cosine("_a", "_b", strict=False), 6)).alias("similarity"))
    if wide:
        return long.groupBy("category_1").pivot("category_2").agg(F.first("similarity"))
    return long


def search_summary(results: DataFrame, queries: DataFrame, qid_col="query_id") -> DataFrame:
    """Queries run, results per query (zero-result queries count), best and worst score.

    The reference's running maximum starts at 0 and its minimum at 1.
    """
    per_q = results.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("similarity").alias("mx"), F.min("similarity").alias("mn")
    )
    all_q = queries.select(F.col(qid_col).alias("query_id")).join(per_q, "query_id", "left")
    return all_q.agg(
        F.count(F.lit(1)).alias("search_queries"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_results"),
        F.round(F.avg(F.coalesce(F.col("n"), F.lit(0))), 6).alias("avg_results_per_search"),
        F.round(F.greatest(F.lit(0.0), F.coalesce(F.max("mx"), F.lit(0.0))), 6).alias("highest_similarity"),
        F.round(F.least(F.lit(1.0), F.coalesce(F.min("mn"), F.lit(1.0))), 6).alias("lowest_similarity"),
    )


def comparison_counts(vectors: DataFrame, queries: DataFrame, vec_col="embedding",
                      qid_col="query_id", qvec_col="query_vector") -> DataFrame:
    """Similarity computations per query = vectors of the query's length (an equi-join
    of the queries with the vector-length histogram; no pair is materialized)."""
    hist = vectors.groupBy(F.size(vec_col).alias("_dim")).agg(F.count(F.lit(1)).alias("comparisons"))
    q = queries.select(F.col(qid_col).alias("query_id"), F.size(qvec_col).alias("_dim"))
    return q.join(hist, "_dim", "left").select(
        "query_id", F.coalesce(F.col("comparisons"), F.lit(0)).cast("long").alias("comparisons")
    )


def append_vectors(table: DataFrame, new_rows: DataFrame, order_col: str, id_col="id") -> DataFrame:
    """Give new rows ids max(id)+1.. in ``order_col`` order; metadata defaults to ``{}``."""
    start = table.select(F.coalesce(F.max(id_col), F.lit(0)).cast("long")).scalar()
    numbered = dense_ids(new_rows, [order_col], "_new_id", offset=start)
    added = numbered.select(
        F.col("_new_id").alias(id_col), "embedding", "content",
        F.coalesce(F.col("metadata"), F.lit("{}")).alias("metadata"),
    )
    return table.select(id_col, "embedding", "content", "metadata").unionByName(added)


def delete_vectors(table: DataFrame, ids: DataFrame, id_col="id") -> tuple[DataFrame, DataFrame]:
    """(remaining rows, one-row count of deleted rows) by anti/semi join on id."""
    remaining = table.join(ids.select(id_col).distinct(), id_col, "left_anti")
    deleted = table.join(ids.select(id_col).distinct(), id_col, "left_semi").agg(
        F.count(F.lit(1)).alias("deleted")
    )
    return remaining, deleted


def synthetic_near_axis(rows: DataFrame, seed: int = 42, variance: float = 0.3, dims_col="dims",
                        axis_col="axis", key_col="id") -> DataFrame:
    """Per input row, a vector near the ``axis`` unit vector: ``clip(1 ± U·v, 0, 1)`` on
    the axis, ``U(0, v/2)`` elsewhere, then unit length. Random numbers come from a hash of
    (seed, key, position), so a retried task recomputes the same vector."""
    idx = F.sequence(F.lit(0), F.col(dims_col) - 1)
    raw = F.transform(
        idx,
        lambda i: F.when(
            i == F.col(axis_col),
            F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                    1.0 + (uniform01(seed, key_col, i) * 2.0 - 1.0) * variance)),
        ).otherwise(uniform01(seed, key_col, i) * (variance / 2.0)),
    )
    return rows.withColumn("embedding", normalize(raw))
