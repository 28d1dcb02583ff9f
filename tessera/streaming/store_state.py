"""Stores found or created while receipts arrive: keyed state, a timer, and one decision per batch.

Once a normalized name has met a store that contains it, later receipts of that name link to the same store (new
stores get higher ids), so only receipts of names not seen yet have to be matched. A stateful processor keeps, per
normalized name, what has been seen (typed state) and forgets names after a time of silence (an event-time timer on the time of the batches). Forgetting is
harmless: the name is asked for again and finds its store. The keys are buckets of names by hash, as a key's state goes to Python
and back once a batch. A hot name is dealt to several buckets by a hash of the receipt, at the price of one question per bucket.

Each batch asks the store table of the batches before it and writes what it decides (questions, new stores, links)
under its batch id; a replayed batch reads and writes the same again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tessera.operators.stores import create_missing, normalize_name
from tessera.session import shared_dir
from tessera.streaming.incremental import _run

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # state beyond the heap
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SEEN = "norm array<string>, receipt_id array<long>, at array<long>"
ROWS = "receipt_id long, store_name string, store_address string, norm string, ask boolean, covers boolean"
TABLES = {"rows": ROWS, "new": "id long, name string, address string, category string", "links": "receipt_id long, store_id long",
          "decided": "norm string, store_id long", "old": "id long, name string, address string, category string"}


def _seen_names(keep_ms: int):
    """The processor, made here so that it travels to the executors by value. Its key is a bucket of names: all names of a
    bucket are looked up, added and forgotten together, so a batch costs one state access per bucket and not several per name."""

    def follow(key, rows: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        names, first, at = state.get if state.exists else ([], [], [])
        seen = pd.DataFrame({"receipt_id": pd.array(first, "Int64"), "at": pd.array(at, "int64")}, index=pd.Index(names, dtype=object))
        covering, now = [], None
        for pdf in rows:
            if pdf.empty:  # a bucket whose timer has gone off
                continue
            now = int(pdf["at"].iloc[0])  # one time for a batch
            known = pdf["norm"].isin(seen.index)
            seen.loc[seen.index.isin(pdf["norm"]), "at"] = now
            covering.append(pdf.loc[pdf["covers"] & ~known, ["norm", "receipt_id"]].groupby("norm")["receipt_id"].min().astype("Int64"))
            yield pdf.assign(ask=~known & (pdf["norm"] != ""))[["receipt_id", "store_name", "store_address", "norm", "ask", "covers"]]
        if covering:  # known from the next batch on
            new = pd.concat(covering).groupby(level=0).min()
            seen = pd.concat([seen, pd.DataFrame({"receipt_id": new, "at": now})]) if len(new) else seen
        seen = seen[seen["at"] + keep_ms > state.getCurrentWatermarkMs()]
        if len(seen):
            state.update((list(seen.index), [None if pd.isna(i) else int(i) for i in seen["receipt_id"]], [int(t) for t in seen["at"]]))
            state.setTimeoutTimestamp(int(seen["at"].min()) + keep_ms)
        elif state.exists:
            state.remove()

    return follow


class Results:
    """The stream's tables, each in folders by batch id: rows as the processor gave them, new stores, links, and names decided."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, df: DataFrame, table: str, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/{table}/batch_id={batch}")

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """A table's rows, or those of the batches before one."""
        df = self.spark.read.schema(f"{TABLES[table]}, batch_id int").parquet(f"{self.path}/{table}")
        return (df if before is None else df.where(F.col("batch_id") < before)).drop("batch_id")

    def begin(self) -> None:
        """Empty tables, so that reading needs no batch."""
        for table, schema in TABLES.items():
            self.write(self.spark.createDataFrame([], schema), table, -1)


def decide(results: Results, batch: int) -> None:
    """Matches the batch's questions against the stores given and those made before, creates what is missing, links all its rows."""
    rows = results.spark.read.schema(ROWS).parquet(f"{results.path}/rows/batch_id={batch}")
    if rows.isEmpty():  # a batch that only moves the time
        for table in ("new", "decided", "links"):
            results.write(results.spark.createDataFrame([], TABLES[table]), table, batch)
        return
    asked = rows.where("ask").select("receipt_id", "store_name", "store_address")
    known = results.read("old").unionByName(results.read("new", batch))
    found, new = create_missing(asked, known)
    results.write(new.select("id", "name", "address", "category"), "new", batch)
    found = found.select("receipt_id", "norm", "store_id")
    # a store whose name contains the normalized name is what later receipts of it find, too
    own = found.join(rows.where("ask and covers").select("receipt_id"), "receipt_id", "left_semi").where("store_id is not null")
    results.write(own.groupBy("norm").agg(F.min("store_id").alias("store_id")), "decided", batch)
    decided = results.read("decided", batch + 1).groupBy("norm").agg(F.min("store_id").alias("store_id"))
    follow = rows.where("not ask").join(decided, "norm", "left").select("receipt_id", "store_id")
    results.write(found.select("receipt_id", "store_id").unionByName(follow), "links", batch)


def stream_stores(receipts: DataFrame, stores: DataFrame, keep_ms: int = 7 * 86_400_000, salts: int = 4, path: str | None = None,
                  checkpoint: str | None = None, buckets: int = 256) -> Results:
    """Runs the stream of ``receipts`` (receipt_id, store_name, store_address) to its end: links and new stores equal those of
    ``create_missing`` over all receipts if they arrive in order of their ids.

    Receipts with a null or blank name get no store (their link is null). ``keep_ms`` is how long a silent name is remembered,
    ``salts`` the buckets that one name's receipts are dealt to, of ``buckets`` for all names. With ``path`` and ``checkpoint`` of an earlier run it goes on there.
    """
    spark = receipts.sparkSession
    results = Results(spark, path or shared_dir(spark, "stream-stores"))
    results.begin()
    results.write(stores.select(F.col("id").cast("long").alias("id"), "name", "address", "category"), "old", -1)
    low = F.lower(F.col("store_name"))
    rows = receipts.select(F.col("receipt_id").cast("long").alias("receipt_id"), "store_name", "store_address", normalize_name("store_name").alias("norm"))
    rows = rows.withColumn("covers", F.coalesce(low.contains(F.col("norm")) & (F.col("norm") != ""), F.lit(False)))
    # the time of the batch is the event time: it only rises, so no receipt is ever late, and a replay finds the same
    rows = rows.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds").withColumn("at", F.unix_millis("arrived"))
    salt = F.pmod(F.xxhash64("receipt_id"), F.lit(salts))
    keyed = rows.withColumn("bucket", F.pmod(F.xxhash64("norm", salt), F.lit(buckets))).groupBy("bucket")

    def sink(df: DataFrame, batch_id: int) -> None:
        own = Results(df.sparkSession, results.path)
        own.write(df, "rows", batch_id)  # the only action on the stream's rows: its state moves once
        decide(results, batch_id)  # over written tables, in the given session: a stream's own runs without adaptive execution

    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        stream = keyed.applyInPandasWithState(_seen_names(keep_ms), ROWS, SEEN, "append", GroupStateTimeout.EventTimeTimeout)
        _run(stream.writeStream.outputMode("append").foreachBatch(sink)
             .option("checkpointLocation", checkpoint or shared_dir(spark, "stream-stores-ckpt")).trigger(availableNow=True).start())
    finally:
        spark.conf.set(PROVIDER, before)
    return results
