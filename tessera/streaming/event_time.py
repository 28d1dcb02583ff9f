"""Event-time streaming: watermark, tumbling, sliding and session windows, late rows apart.

Rows arrive out of order. A window's state is kept until the watermark (the largest event time
of the batches before, less the delay) passes its end; then it is emitted once (append output)
and dropped, so state is bounded by the open windows. What comes for a window that was already
dropped is late: Spark leaves it out of the aggregate, and ``late_rows`` keeps it apart.

A file stream forms batches by number of files in the order of their arrival. ``arrive`` publishes a
table's rows that way: one arrival after another, each in the same number of files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tessera.session import shared_dir
from tessera.streaming.incremental import _run, file_stream, run_to_table


def arrive(rows: DataFrame, arrival: str, id_col: str, folder: str, files: int) -> DataFrame:
    """Publishes ``rows`` to ``folder`` in order of ``arrival`` (0, 1, ...), each as ``files`` files, and returns the file
    stream whose batches are the arrivals. ``id_col`` (whole numbers, without gaps) deals rows to files."""
    spark = rows.sparkSession
    rows = rows.withColumn("_file", F.pmod(id_col, F.lit(files)))
    last = rows.agg(F.max(arrival)).first()[0]
    for k in range(-1 if last is None else last + 1):
        rows.where(F.col(arrival) == k).repartition("_file").write.partitionBy("_file").mode("append").parquet(folder)
    if last is None:
        rows.write.partitionBy("_file").parquet(folder)
    return file_stream(spark, folder, rows.schema, files).drop("_file")


def windows(stream: DataFrame, time: str, delay: str, size: str, aggs: Sequence[Column], slide: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Tumbling (or with ``slide`` sliding) windows per key: start, end, keys, aggregates. Null times are in no window."""
    w = F.window(time, size, slide) if slide else F.window(time, size)
    out = stream.where(F.col(time).isNotNull()).withWatermark(time, delay).groupBy(w.alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in out.columns if c != "w"])


def sessions(stream: DataFrame, time: str, delay: str, gap: str, aggs: Sequence[Column], keys: Sequence[str]) -> DataFrame:
    """Session windows per key: rows of a key whose distance stays within ``gap`` are one session."""
    out = stream.where(F.col(time).isNotNull()).withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), *keys).agg(*aggs)
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *[c for c in out.columns if c != "w"])


def _nothing(spark: SparkSession, schema: StructType, path: str) -> None:
    """A table that can be read when no batch comes."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{path}/batch_id=-1")


def closed(stream: DataFrame, name: str, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """The windows that have closed, each once; a batch writes under its id, so a replayed batch replaces its own."""
    spark = stream.sparkSession
    path = path or shared_dir(spark, name)
    _nothing(spark, stream.schema, path)
    run_to_table(stream, path, "append", name, checkpoint)
    return spark.read.schema(stream.schema).parquet(path).select(*stream.columns)


def late_rows(stream: DataFrame, time: str, delay: str, closes: Column, name: str) -> DataFrame:
    """All rows with the batch they came in and whether they were ``late``: ``closes`` (the end of the row's window, or for sessions its time
    plus the gap) isn't after the watermark by which windows were dropped before the batch.

    Each batch writes its rows and its largest time under its id. Windows are dropped at the end of a batch by the largest
    time of the batches before it, so batch b finds its bound in the batches up to b - 2."""
    spark = stream.sparkSession
    rows_at, times_at = shared_dir(spark, f"{name}-rows"), shared_dir(spark, f"{name}-times")
    schema = StructType([*stream.schema.fields, StructField("late", BooleanType()), StructField("batch_id", IntegerType())])

    def sink(df: DataFrame, batch_id: int) -> None:
        own = df.sparkSession
        # every batch has a row here, also one of null times only
        df.agg(F.max(time).alias("top")).write.mode("overwrite").parquet(f"{times_at}/batch_id={batch_id}")
        before = [f"{times_at}/batch_id={b}" for b in range(batch_id - 1)]
        bound = own.read.parquet(*before).select(F.max("top")).scalar() if before else F.lit(None)
        bound = F.date_trunc("millisecond", bound.cast("timestamp")) - F.expr(f"INTERVAL {delay}")
        timed = df.where(F.col(time).isNotNull()).withColumn("late", F.coalesce(closes.cast("timestamp") <= bound, F.lit(False)))
        marked = timed.unionByName(df.where(F.col(time).isNull()).withColumn("late", F.lit(False)))  # in no window, so not late
        marked.write.mode("overwrite").parquet(f"{rows_at}/batch_id={batch_id}")

    _nothing(spark, schema, rows_at)
    _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", shared_dir(spark, f"{name}-ckpt"))
         .trigger(availableNow=True).start())
    return spark.read.schema(schema).parquet(rows_at)
