"""Difference of two versions of a table: what was inserted, deleted, updated, or stands under a repeated key.

Both versions are counted together per key and row, so equal rows cancel before anything is compared and no pair of rows is
made: a null-safe full outer join in one hash aggregate, with partial sums where the rows are. A key with
many rows is spread by its rows; only its totals meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES = 1 << 12  # rows that one counted row unrolls to in a step


def _counted(old: DataFrame, new: DataFrame) -> DataFrame:
    both = old.withColumns({"_old": F.lit(1).cast("long"), "_new": F.lit(0).cast("long")}).unionByName(
        new.withColumns({"_old": F.lit(0).cast("long"), "_new": F.lit(1).cast("long")}))
    return both.groupBy(*old.columns).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))


def difference(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """A row per changed row of either version: its columns, ``change`` and ``copies`` (how many more the new version has of it).

    ``insert``: the key is new; ``delete``: it is gone; ``update_from`` and ``update_to``: it stands once in both, with other
    values; ``repeated``: it stands more than once in a version, so which row became which is open. Null keys equal
    each other. Both versions have the same columns, in any order, of types that can be grouped.
    """
    key = list(key)
    rows = _counted(old, new.select(*old.columns))
    totals = rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key]).agg(F.sum("_old").alias("_olds"), F.sum("_new").alias("_news"))
    changed = rows.where("_old <> _new")
    same = F.lit(True)
    for k in key:
        same = same & changed[k].eqNullSafe(totals[f"_k_{k}"])
    change = (F.when(F.greatest("_olds", "_news") > 1, "repeated").when(F.col("_olds") == 0, "insert").when(F.col("_news") == 0, "delete")
              .when(F.col("_old") == 1, "update_from").otherwise("update_to"))
    return changed.join(totals, same).select(*old.columns, change.alias("change"), (F.col("_new") - F.col("_old")).alias("copies"))


def apply(old: DataFrame, changes: DataFrame) -> DataFrame:
    """The new version, from the old one and its difference: rows as often as they are left."""
    left = old.withColumn("copies", F.lit(1).cast("long")).unionByName(changes.select(*old.columns, "copies"))
    left = left.groupBy(*old.columns).agg(F.sum("copies").alias("_n")).where("_n > 0")
    # many copies of one row unroll in two steps, the first dealt out
    parts = left.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(COPIES).cast("long"))))
    parts = parts.repartition("_from", *old.columns)
    return parts.withColumn("_i", F.explode(F.sequence("_from", F.least(F.col("_from") + COPIES - 1, F.col("_n"))))).select(*old.columns)


def common(old: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of both versions, as often as in the one that has fewer: rows and ``copies``."""
    return _counted(old, new.select(*old.columns)).withColumn("copies", F.least("_old", "_new")).where("copies > 0").drop("_old", "_new")
