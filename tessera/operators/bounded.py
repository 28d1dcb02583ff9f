"""Distributed dense numbering.

``dense_ids`` numbers rows 1..n in a key order without a single-partition window: a
range shuffle, a per-partition position, and per-partition offsets computed over a table
that has one row per partition. The ranged rows are checkpointed once so both passes
see the same partitioning (and a lost executor does not renumber anything).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, shared_dir


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage like a checkpoint, and later joins see its size."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dense_ids(df: DataFrame, order_cols: list[str], id_col: str = "dense_id", offset=None,
              num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = offset + 1..n following ``order_cols`` (which must be unique).

    ``offset`` may be a number or a scalar Column (e.g. ``df.select(max(..)).scalar()``).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds come from sampling, which may differ between two evaluations of an
    # input whose row order is not fixed; a reliable checkpoint (shared folder) pins the
    # partitioning once, so the partition counts and the positions agree.
    ranged = (
        df.repartitionByRange(parts, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
        .withColumn("_pid", F.shiftright(F.col("_mid"), 33))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    per_part = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: a global running sum over it is tiny.
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_start"))
    out = ranged.join(starts, "_pid")
    base = F.col("_start") + F.col("_pos") + 1
    if offset is None:
        out = out.withColumn(id_col, base)
    elif isinstance(offset, Column):
        out = out.withColumn(id_col, offset + base)
    else:
        out = out.withColumn(id_col, F.lit(offset) + base)
    return out.drop("_mid", "_pid", "_pos", "_start")
