"""Frequent values in bounded space: a mergeable summary with an error bound, then one exact recount.

A summary holds at most ``capacity`` values of each counter. Merging adds counts; if more values than that are left, the count
of the next one is taken off all (and what falls to zero goes), and added to the counter's error. So each value's true
count lies between its count and its count plus the error (for a value that isn't held: at most the error), and
the error is at most rows / (capacity + 1), in whatever order summaries of parts are merged.

``top`` recounts exactly those values that can be among the k most frequent. Where the k-th count doesn't exceed the
error, the summary was too small to be sure, and that counter is counted in full.

Rows are (counter, value, count); the row with a null value holds the counter's error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import shared_dir
from tessera.streaming.incremental import _run

SCHEMA = "counter string, value string, count long"


def _cut(counts: DataFrame, capacity: int) -> DataFrame:
    by = Window.partitionBy("counter").orderBy(F.desc("count"), "value")
    top = counts.where("value is not null").withColumn("rn", F.row_number().over(by)).where(F.col("rn") <= capacity + 1)
    over = F.max(F.when(F.col("rn") == capacity + 1, F.col("count"))).over(Window.partitionBy("counter"))
    top = top.withColumn("over", F.coalesce(over, F.lit(0).cast("long")))  # capacity + 1 rows a counter
    error = top.groupBy("counter").agg(F.max("over").alias("count")).unionByName(counts.where("value is null").select("counter", "count"))
    error = error.groupBy("counter").agg(F.sum("count").alias("count")).select("counter", F.lit(None).cast("string").alias("value"), "count")
    kept = top.where((F.col("rn") <= capacity) & (F.col("count") > F.col("over")))
    return kept.select("counter", "value", (F.col("count") - F.col("over")).alias("count")).unionByName(error)


def summarize(pairs: DataFrame, capacity: int) -> DataFrame:
    """The summary of (counter, value) rows; null values aren't counted."""
    counts = pairs.where("counter is not null and value is not null").groupBy("counter", "value").agg(F.count(F.lit(1)).alias("count"))
    return _cut(counts, capacity)


def merge(a: DataFrame, b: DataFrame, capacity: int) -> DataFrame:
    return _cut(a.unionByName(b).groupBy("counter", "value").agg(F.sum("count").alias("count")), capacity)


def top(pairs: DataFrame, summary: DataFrame, k: int) -> DataFrame:
    """The k most frequent values of each counter with exact counts (ties by value): counter, value, count, rank, error, certain.

    ``summary`` is of the same rows; ``certain`` tells whether it was large enough. An empty table gives no rows."""
    error = summary.where("value is null").select("counter", F.col("count").alias("error"))
    by = Window.partitionBy("counter").orderBy(F.desc("count"), "value")
    held = summary.where("value is not null").withColumn("rn", F.row_number().over(by))
    least = held.where(F.col("rn") == k).select("counter", F.col("count").alias("least"))
    bounds = error.join(least, "counter", "left").withColumn("certain", (F.col("error") == 0) | (F.coalesce("least", F.lit(0)) > F.col("error")))
    wanted = held.join(bounds, "counter").where(F.col("count") + F.col("error") >= F.coalesce("least", F.lit(0))).select("counter", "value", "certain")
    wanted = wanted.where("certain").select("counter", "value")
    rows = pairs.where("value is not null")
    few = rows.join(wanted, ["counter", "value"], "left_semi")
    full = rows.join(bounds.where("not certain").select("counter"), "counter", "left_semi")
    counts = few.unionByName(full).groupBy("counter", "value").agg(F.count(F.lit(1)).alias("count"))
    ranked = counts.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.join(bounds.select("counter", "error", "certain"), "counter")


def stream_summary(pairs: DataFrame, capacity: int, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The summary of a stream of (counter, value) rows. Each batch writes the summary up to it under its id, from that of the
    batch before: state is ``capacity`` rows a counter, a replayed batch writes the same again, readers see whole versions."""
    spark = pairs.sparkSession
    path = path or shared_dir(spark, "frequent")

    def version(own: SparkSession, batch: int) -> DataFrame:
        return own.read.schema(SCHEMA).parquet(f"{path}/batch_id={batch}").select("counter", "value", "count")

    def sink(df: DataFrame, batch_id: int) -> None:
        own = df.sparkSession
        merged = merge(version(own, batch_id - 1), summarize(df.select("counter", "value"), capacity), capacity)
        merged.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    spark.createDataFrame([], SCHEMA).write.mode("overwrite").parquet(f"{path}/batch_id=-1")
    _run(pairs.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint or shared_dir(spark, "frequent-ckpt")).trigger(availableNow=True).start())
    versions = spark.read.schema(f"{SCHEMA}, batch_id int").parquet(path)
    return versions.where(F.col("batch_id") == versions.select(F.max("batch_id")).scalar()).drop("batch_id")
