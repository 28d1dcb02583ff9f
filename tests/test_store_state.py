"""Stores found and created by a stream of receipts against the batch loop's result: forgotten names, replays, odd names."""

import os

from tessera.operators.stores import create_missing
from tessera.session import shared_dir
from tessera.streaming.event_time import arrive
from tessera.streaming.store_state import stream_stores

NAMES = ["Big Mart Sdn Bhd", "Mart", "Plaza   Mart", "plaza mart", "Big Mart", None, "  ", "Ltd", "Mart", "Old Shop East", "old shop", "Plaza   Mart",
         "Hot", "Hot", "Hot", "Very Hot", "hot ltd", "Plaza Mart", "Mart", "Zoo"]
RECEIPTS = [(i, NAMES[i % len(NAMES)] if i % 3 else "Hot Corner", None if i % 4 else f"No {i}") for i in range(60)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stream_equals_the_loop_when_names_are_forgotten_and_batches_replayed(spark):
    df = spark.createDataFrame([(*r, r[0] * 5 // 60) for r in RECEIPTS], "receipt_id long, store_name string, store_address string, arrival int")
    stores = spark.createDataFrame([(7, "Old Shop East Wing", None, "Other"), (9, "Old Shop", "x", "Other")], "id long, name string, address string, category string")
    linked, new = create_missing(df.drop("arrival"), stores)
    links, made = rows(linked.select("receipt_id", "store_id")), rows(new.select("id", "name", "address", "category"))
    stream = arrive(df, "arrival", "receipt_id", shared_dir(spark, "test-receipts"), 2).drop("arrival")
    path, ckpt = shared_dir(spark, "test-stores"), shared_dir(spark, "test-stores-ckpt")
    results = stream_stores(stream, stores, keep_ms=1, salts=2, path=path, checkpoint=ckpt)
    assert rows(results.read("links")) == links and rows(results.read("new")) == made
    asked = rows(results.read("rows").where("ask").groupBy("norm").count())
    assert dict(asked)["hot corner"] < 20  # known names aren't asked for
    commits = os.path.join(ckpt.removeprefix("file:"), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    again = stream_stores(stream, stores, keep_ms=1, salts=2, path=path, checkpoint=ckpt)
    assert rows(again.read("links")) == links and rows(again.read("new")) == made
