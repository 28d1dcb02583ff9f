"""As-of join: each left row with the latest earlier (or earliest later) right row of its key.

Both sides are united and sorted once by (key, time); the last right row before a left row is
carried on to it, so no pair of rows is ever made. The sort is a range shuffle whose bounds
include the time and a tie-breaker: a key, or even one instant, with a third of all rows is
spread over many tasks. The sorted rows are checkpointed with their partition's number, a
window inside each partition carries right rows on, and what enters a partition from the ones
before it comes from a table with one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, *, ties: Sequence[str] = (),
              allow_equal: bool = False, direction: str = "backward", tolerance: Column | None = None, prefix: str = "",
              partitions: int | None = None) -> DataFrame:
    """All left rows with the columns of their match (names with ``prefix``; null without a match).

    ``on`` are columns of the same names on both sides, the times columns of one type. Of right rows at one time, the
    last by ``ties`` wins (by default by all its columns). ``tolerance`` (an interval or number) bounds the distance in time.
    A null in a key or time matches nothing: such left rows stay, such right rows go. Left rows that repeat are kept each. The
    columns of ``right`` but its keys must not clash with those of ``left`` after ``prefix``.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction is backward or forward, not {direction}")
    spark = left.sparkSession
    ensure_checkpoint_dir(spark)
    on, carried = list(on), [c for c in right.columns if c not in on]
    clash = {prefix + c for c in carried} & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides, give a prefix: {sorted(clash)}")
    there = lambda df, time: ~F.greatest(*[F.col(c).isNull() for c in [*on, time]], F.lit(False))
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(on)]) if on else F.struct(F.lit(0).alias("k0"))
    mine, its = F.struct(*left.columns), F.struct(*carried)
    order_of = F.struct(*(ties or carried))
    none_left, none_right = F.lit(None).cast(left.select(mine).schema[0].dataType), F.lit(None).cast(right.select(its).schema[0].dataType)
    none_tie = F.lit(None).cast(right.select(order_of).schema[0].dataType)
    # at one time right rows come first if they count, last if they don't
    rows = left.where(there(left, left_time)).select(
        key.alias("k"), F.col(left_time).alias("t"), F.lit(allow_equal).alias("is_later"), none_tie.alias("tie"),
        F.xxhash64(*left.columns).alias("spread"), mine.alias("l"), none_right.alias("r"))
    rows = rows.unionByName(right.where(there(right, right_time)).select(
        key.alias("k"), F.col(right_time).alias("t"), F.lit(not allow_equal).alias("is_later"), order_of.alias("tie"),
        F.lit(0).cast("long").alias("spread"), none_left.alias("l"), its.alias("r")))
    time = F.col("t").asc() if direction == "backward" else F.col("t").desc()
    order = [F.col("k"), time, F.col("is_later"), F.col("tie"), F.col("spread")]
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
              .select("k", "t", "l", "r", F.monotonically_increasing_id().alias("at")).checkpoint(eager=True)
              .withColumn("part", F.shiftright("at", 33)))
    a_right = F.when(F.col("l").isNull(), F.struct("k", "t", "r"))
    # one row a partition: the last right row of all partitions before it
    ends = ranged.where(F.col("l").isNull()).groupBy("part").agg(F.max_by(F.struct("k", "t", "r"), "at").alias("last"))
    every = ranged.select("part").distinct().join(ends, "part", "left")
    enters = every.select("part", F.last("last", ignorenulls=True).over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("enters"))
    before = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (ranged.withColumn("here", F.last(a_right, ignorenulls=True).over(before)).where(F.col("l").isNotNull())
             .join(enters, "part", "left").withColumn("m", F.coalesce("here", "enters")))
    ok = F.col("m.k") == F.col("k")
    if tolerance is not None:
        apart = F.col("t") - F.col("m.t") if direction == "backward" else F.col("m.t") - F.col("t")
        ok = ok & (apart <= tolerance)
    out = found.withColumn("m", F.when(ok, F.col("m.r"))).select("l.*", *[F.col(f"m.{c}").alias(prefix + c) for c in carried])
    types = {f.name: f.dataType for f in right.schema}
    rest = left.where(~there(left, left_time)).select("*", *[F.lit(None).cast(types[c]).alias(prefix + c) for c in carried])
    return out.unionByName(rest)
