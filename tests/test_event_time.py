"""Event-time windows in a stream: out-of-order and late rows, null times, empty tables, a hot key, replays."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tessera.session import shared_dir
from tessera.streaming import event_time as T

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def arrivals(spark, rows):
    """rows: (arrival, hour or None, key)."""
    data = [(i, a, None if h is None else START + dt.timedelta(hours=h), k) for i, (a, h, k) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, arrival int, ts timestamp, k string")
    return T.arrive(df, "arrival", "id", shared_dir(spark, "test-arrivals"), 2)


def hours(rows):
    return sorted(((int((r.start.astimezone(dt.timezone.utc) - START).total_seconds() // 3600), r.k, r.n) for r in rows), key=lambda x: (x[0], str(x[1])))


# a hot key with most rows; windows of 12 hours, delay 5 hours: batch b drops what ended by max(<= b-1) - 5
ROWS = ([(0, 1, "hot")] * 6 + [(0, 12, "a"), (0, None, "a")] + [(1, 31, "hot")] * 4 + [(1, 3, "b"), (1, None, None)]
        + [(2, 4, "hot"), (2, 33, None)] + [(3, 5, "late"), (3, 25, "a"), (3, 64, "hot")] + [(4, 24, "late"), (4, 66, "a")])
CLOSED = [(0, "b", 1), (0, "hot", 7), (12, "a", 1), (24, "a", 1), (24, "late", 1), (24, None, 1), (24, "hot", 4)]


def count():
    return [F.count(F.lit(1)).alias("n")]


def test_windows_close_once_and_leave_late_rows_out(spark):
    # hour 4 comes in batch 2, at whose end its window goes, so it counts; 5 comes in batch 3, too late; 24 comes in
    # batch 4 while its window is still open; the window of 64 and 66 doesn't close
    got = T.closed(T.windows(arrivals(spark, ROWS), "ts", "5 hours", "12 hours", count(), keys=["k"]), "test-w")
    assert got.columns == ["start", "end", "k", "n"]
    late = T.late_rows(arrivals(spark, ROWS), "ts", "5 hours", F.window("ts", "12 hours")["end"], "test-l").collect()
    assert len(late) == len(ROWS) and sorted((r.arrival, r.k) for r in late if r.late) == [(3, "late")]
    assert all(r.batch_id == r.arrival for r in late)
    assert hours(got.collect()) == sorted(CLOSED, key=lambda x: (x[0], str(x[1])))


def test_a_replayed_batch_changes_nothing(spark):
    stream = T.windows(arrivals(spark, ROWS), "ts", "5 hours", "12 hours", count(), keys=["k"])
    path, ckpt = shared_dir(spark, "test-out"), shared_dir(spark, "test-ckpt")
    first = T.closed(stream, "test-r", path, ckpt).orderBy("start", "k").collect()
    commits = os.path.join(ckpt.removeprefix("file:"), "commits")
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):  # as if the job had ended before the last batch was noted as done
        if os.path.exists(os.path.join(commits, f)):
            os.remove(os.path.join(commits, f))
    assert T.closed(stream, "test-r", path, ckpt).orderBy("start", "k").collect() == first


def test_sessions_join_across_batches(spark):
    rows = [(0, 0, "a"), (0, 2, "b"), (1, 4, "a"), (1, 11, "b"), (2, 8, "a"), (2, 100, "hot"), (3, 200, "hot"), (4, 300, "hot")]
    got = T.closed(T.sessions(arrivals(spark, rows), "ts", "3 hours", "5 hours", count(), ["k"]), "test-s").collect()
    assert hours(got) == [(0, "a", 3), (2, "b", 1), (11, "b", 1), (100, "hot", 1), (200, "hot", 1)]


def test_streams_without_rows(spark):
    empty = arrivals(spark, [])
    assert T.closed(T.windows(empty, "ts", "1 hour", "1 hour", count(), keys=["k"]), "test-e").count() == 0
    nulls = arrivals(spark, [(0, None, "a"), (0, None, "b"), (1, None, "a")])
    assert T.closed(T.windows(nulls, "ts", "1 hour", "1 hour", count(), keys=["k"]), "test-e").count() == 0
    assert [r.late for r in T.late_rows(arrivals(spark, [(0, None, "a"), (0, None, "b")]), "ts", "1 hour", F.col("ts"), "test-e").collect()] == [False, False]
