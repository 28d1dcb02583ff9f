"""Exact cosine search that reads only the groups of vectors that can hold an answer (V2, V3).

``build`` clusters the vectors once around pivots and writes them by group, with each group's centre and radius (of the vectors
at length one). A group's vectors are at least |query - centre| - radius away from a query, which bounds their cosine
from above. ``search`` first takes, per query, the nearest groups that hold k vectors, scores those, and then reads the groups
whose bound reaches the k-th best so far: the rest isn't read (partitions of the written table), and the
result is that of the full search.

Pivots are a bounded sample; they decide only how much is read. Vectors that can't be placed (zero, not finite, or of a
length without a pivot) are in groups that are always read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.vector_fns import cosine, dot, is_valid_embedding, norm, normalize
from tessera.operators.bounded import saved
from tessera.session import shared_dir

LOOSE = -1  # the group of vectors without a place
SLACK = 1e-9  # for rounding in bounds; answers are decided on the vectors themselves


@dataclass
class VectorIndex:
    vectors: DataFrame  # id, v, vn, dim, grp; written by grp
    groups: DataFrame  # grp, dim, centre, radius, n


def build(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding", pivots: int = 64) -> VectorIndex:
    """Clusters and writes ``vectors`` around at most ``pivots`` of them (chosen by a hash of the id). Null and empty vectors match nothing and go."""
    spark: SparkSession = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.size("v") > 0)
    rows = rows.withColumns({"vn": norm("v"), "dim": F.size("v")})
    placed = is_valid_embedding("v") & (F.col("vn") > 0) & (F.col("vn") < float("inf"))
    chosen = saved(rows.where(placed).orderBy(F.xxhash64("id"), "id").limit(pivots).select("dim", normalize("v").alias("u"))
                   .withColumn("p", F.row_number().over(Window.orderBy("dim", "u"))), "pivots")  # a bounded list
    every = chosen.agg(F.collect_list(F.struct("p", "dim", "u"))).select(F.col("collect_list(struct(p, dim, u))")).scalar()
    near = F.array_max(F.transform(F.filter(F.col("_p"), lambda x: x["dim"] == F.col("dim")), lambda x: F.struct((dot("v", x["u"]) / F.col("vn")).alias("s"), x["p"].alias("p"))))
    at = rows.withColumn("_p", every).withColumn("_n", F.when(placed, near))
    at = at.select("id", "v", "vn", "dim", F.coalesce("_n.p", F.lit(LOOSE)).alias("grp"), F.col("_n.s").alias("s"))
    path = shared_dir(spark, "vector-index")
    at.write.partitionBy("grp").parquet(path)
    held = spark.read.schema(at.schema).parquet(path)
    groups = held.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("s").alias("least"))
    # two unit vectors of cosine s are sqrt(2 - 2 s) apart
    groups = groups.join(chosen.select(F.col("p").alias("grp"), "dim", F.col("u").alias("centre")), "grp", "left").select(
        "grp", "dim", "centre", "n", F.sqrt(F.greatest(2 - 2 * F.col("least"), F.lit(0.0))).alias("radius"))
    return VectorIndex(held.drop("s"), saved(groups, "vector-groups"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("similarity"), F.asc("id"))
    return scored.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(index: VectorIndex, queries: DataFrame, k: int = 5, min_similarity: float = 0.0, qid_col: str = "query_id",
           qvec_col: str = "query_vector") -> tuple[DataFrame, DataFrame]:
    """(top k per query as ``vectors.search_many`` gives them, one row with ``vectors``, ``read`` and the ``share`` read).

    The queries are a stated set, met with the groups (not the vectors) to find their bounds. Queries that are null or empty match nothing."""
    q = queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).cast("array<double>").alias("q")).where(F.size("q") > 0)
    q = saved(q.withColumns({"qn": norm("q"), "qdim": F.size("q")}), "vector-queries")
    g = index.groups
    # a group of vectors without a place may hold any length: it has no dim
    pairs = q.join(g, (g["dim"] == q["qdim"])).unionByName(q.withColumn("_all", F.lit(LOOSE)).join(g.where(F.col("grp") == LOOSE), F.col("_all") == F.col("grp")).drop("_all"))
    apart = F.sqrt(F.greatest(2 - 2 * F.try_divide(dot("centre", "q"), F.col("qn")), F.lit(0.0)))
    gap = F.greatest(apart - F.col("radius") - SLACK, F.lit(0.0))
    known = F.col("centre").isNotNull() & (F.col("qn") > 0) & is_valid_embedding("q")
    bound = F.when(~known, F.lit(float("inf"))).otherwise(1 - gap * gap / 2 + SLACK)
    bounds = saved(pairs.select("query_id", "q", "qn", "qdim", "grp", "n", bound.alias("bound")), "vector-bounds").where(F.col("bound") >= min_similarity)

    def scored(wanted: DataFrame) -> DataFrame:
        some = [r["grp"] for r in wanted.select("grp").distinct().collect()]  # group numbers, no more than pivots
        vectors = index.vectors.where(F.col("grp").isin(some))  # only their folders are listed and read
        met = vectors.join(wanted, "grp").where(F.col("dim") == F.col("qdim"))
        met = met.select("query_id", "id", cosine("v", "q", "vn", "qn", strict=False).alias("similarity"))
        return met.where(F.col("similarity") >= F.lit(min_similarity))

    by = Window.partitionBy("query_id").orderBy(F.desc("bound"), "grp").rowsBetween(Window.unboundedPreceding, -1)
    first = bounds.withColumn("before", F.coalesce(F.sum("n").over(by), F.lit(0))).where(F.col("before") < k).drop("before")
    least = _best(scored(first), k).where(F.col("rank") == k).select("query_id", F.col("similarity").alias("least"))
    wanted = saved(bounds.join(least, "query_id", "left").where(F.col("least").isNull() | F.isnan("least") | (F.col("bound") >= F.col("least"))).drop("least"), "vector-wanted")
    result = _best(scored(wanted), k).select("query_id", "rank", "id", "similarity")
    read = wanted.select("grp", "n").distinct().agg(F.coalesce(F.sum("n"), F.lit(0)).alias("read"))
    share = g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("vectors")).withColumn("read", read.scalar()).withColumn("share", F.try_divide("read", "vectors"))
    return result, share
