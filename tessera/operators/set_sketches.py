"""Distinct keys of days and their overlaps, from one mergeable sketch per day (or any other period).

A theta sketch keeps the 2^lg smallest hashes of a day's keys. Sketches of days are joined to unions, intersections and
differences without the rows: one aggregation writes one row a day, everything after reads that small table. The estimate of a
set is within ``deviations`` standard errors, 1 / sqrt(2^lg - 1) each, of the union it is a part of; sets that fit the sketch are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import shared_dir


def daily_sketches(rows: DataFrame, day: str, key: str, lg: int = 12) -> DataFrame:
    """(day, sketch), written: partial sketches are made where the rows are. Null days and keys don't count."""
    path = shared_dir(rows.sparkSession, "sketches")
    kept = rows.where(F.col(day).isNotNull() & F.col(key).isNotNull())
    kept.groupBy(F.col(day).alias("day")).agg(F.theta_sketch_agg(key, F.lit(lg)).alias("sketch")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _pairs(days: DataFrame, lags: int, *columns: str) -> DataFrame:
    """Days with each of the ``lags`` days before them that occur: an equi-join on the day."""
    later = days.select(F.col("day"), F.explode(F.sequence(F.lit(1), F.lit(lags))).alias("lag"), *[F.col(c).alias(f"b_{c}") for c in columns])
    earlier = days.select(F.col("day").alias("earlier"), *[F.col(c).alias(f"a_{c}") for c in columns])
    return later.withColumn("earlier", F.date_sub("day", F.col("lag"))).join(earlier, "earlier")


def estimates(sketches: DataFrame, lags: int = 7, lg: int = 12, deviations: float = 4.0) -> DataFrame:
    """Per pair of days up to ``lags`` apart the estimated sizes: of both, of their union, of what they share (kept), of what
    is only in the earlier (lost) and only in the later (gained), and the error ``bound`` of each."""
    size = lambda c: F.theta_sketch_estimate(c)
    a, b = F.col("a_sketch"), F.col("b_sketch")
    out = _pairs(sketches, lags, "sketch").select(
        "earlier", "day", size(a).alias("n_earlier"), size(b).alias("n_day"), size(F.theta_union(a, b, F.lit(lg))).alias("n_union"),
        size(F.theta_intersection(a, b)).alias("n_kept"), size(F.theta_difference(a, b)).alias("n_lost"), size(F.theta_difference(b, a)).alias("n_gained"))
    exact = F.col("n_union") < 2**lg
    return out.withColumn("bound", F.when(exact, 0.0).otherwise(F.col("n_union") * (deviations / (2**lg - 1) ** 0.5)))


def overlaps(rows: DataFrame, day: str, key: str, lags: int = 7) -> DataFrame:
    """The same sizes, exact: keys of a day meet those of the days before by equi-join, distinct keys per day."""
    seen = rows.where(F.col(day).isNotNull() & F.col(key).isNotNull()).select(F.col(day).alias("day"), F.col(key).alias("key")).distinct()
    n = seen.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    both = (seen.select("key", "day", F.explode(F.sequence(F.lit(1), F.lit(lags))).alias("lag")).withColumn("earlier", F.date_sub("day", F.col("lag")))
            .join(seen.select("key", F.col("day").alias("earlier")), ["key", "earlier"]).groupBy("earlier", "day").agg(F.count(F.lit(1)).alias("n_kept")))
    out = _pairs(n, lags, "n").join(both, ["earlier", "day"], "left").withColumn("n_kept", F.coalesce("n_kept", F.lit(0).cast("long")))
    return out.select("earlier", "day", F.col("a_n").alias("n_earlier"), F.col("b_n").alias("n_day"), (F.col("a_n") + F.col("b_n") - F.col("n_kept")).alias("n_union"),
                      "n_kept", (F.col("a_n") - F.col("n_kept")).alias("n_lost"), (F.col("b_n") - F.col("n_kept")).alias("n_gained"))
