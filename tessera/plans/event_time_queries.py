"""Registered event-time queries over the events, which arrive in six files' worth of disorder, and their DuckDB oracles.

An event arrives with its part of the month; every 13th one part later, every 101st three. The delay is three days, so
some of them come after their window has closed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.times import utc_clock, utc_instant
from tessera.session import shared_dir
from tessera.sources.tables import Tables
from tessera.streaming import event_time as T

ARRIVALS, DELAY, FILES = 6, "3 days", 4


def _events(spark, d, *columns):
    e = Tables(spark, d).events
    part = F.floor(F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / 5.2)
    later = F.when(F.col("event_id") % 101 == 0, 3).when(F.col("event_id") % 13 == 0, 1).otherwise(0)
    rows = e.select("event_id", *columns, utc_instant(F.col("ts")).alias("ts"), F.least(part + later, F.lit(ARRIVALS - 1)).cast("int").alias("arrival"))
    return T.arrive(rows, "arrival", "event_id", shared_dir(spark, "event-arrivals"), FILES)


def _clock(df):
    return df.withColumns({c: utc_clock(F.col(c)) for c in ("start", "end")})


def t07_tumbling(spark, d):
    """Closed windows of six hours per event type."""
    aggs = [F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high")]
    return _clock(T.closed(T.windows(_events(spark, d, "event_type", "value"), "ts", DELAY, "6 hours", aggs, keys=["event_type"]), "t07w"))


def t07_sliding(spark, d):
    """Closed windows of a day, one every six hours."""
    aggs = [F.count(F.lit(1)).alias("n"), F.max("value").alias("high")]
    return _clock(T.closed(T.windows(_events(spark, d, "value"), "ts", DELAY, "24 hours", aggs, slide="6 hours"), "t07s"))


def t07_sessions(spark, d):
    """Closed sessions of a user: events within six hours of each other."""
    aggs = [F.count(F.lit(1)).alias("n"), F.max("value").alias("high")]
    return _clock(T.closed(T.sessions(_events(spark, d, "user_id", "value"), "ts", DELAY, "6 hours", aggs, ["user_id"]), "t07u"))


def t07_late_events(spark, d):
    """Per arrival the events, and those whose window of six hours had been dropped."""
    rows = T.late_rows(_events(spark, d), "ts", DELAY, F.window("ts", "6 hours")["end"], "t07l")
    return rows.groupBy(F.col("arrival").cast("long").alias("arrival")).agg(F.count(F.lit(1)).alias("n"), F.count_if("late").alias("n_late"))


def _bound(upto: str) -> str:
    return f"(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 3 DAY FROM a WHERE arrival <= {upto})"


_A = f"""a AS (SELECT *, CAST(least(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 5.2)
    + CASE WHEN event_id % 101 = 0 THEN 3 WHEN event_id % 13 = 0 THEN 1 ELSE 0 END, {ARRIVALS - 1}) AS BIGINT) AS arrival FROM events),
    late_by AS (SELECT k AS arrival, {_bound('k - 2')} AS bound FROM range({ARRIVALS}) t(k))"""
_DONE = _bound(str(ARRIVALS))
_OPEN = "(bound IS NULL OR \"end\" > bound)"


def _session_sql() -> str:
    """The rule arrival by arrival: rows that aren't late join the open sessions, and what has ended is given out."""
    parts, out = [], []
    state = "SELECT NULL::BIGINT AS user_id, NULL::TIMESTAMP AS s, NULL::TIMESTAMP AS e, NULL::BIGINT AS n, NULL::DOUBLE AS high WHERE false"
    for b in range(ARRIVALS + 1):
        rows = "" if b == ARRIVALS else f""" UNION ALL SELECT user_id, ts, ts + INTERVAL 6 HOUR, 1, value FROM a JOIN late_by USING (arrival)
            WHERE arrival = {b} AND (bound IS NULL OR ts + INTERVAL 6 HOUR > bound)"""
        parts.append(f"all{b} AS ({state}{rows})")
        parts.append(f"""new{b} AS (SELECT *, coalesce(s > max(e) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS fresh FROM all{b})""")
        parts.append(f"""mrg{b} AS (SELECT user_id, min(s) AS s, max(e) AS e, CAST(sum(n) AS BIGINT) AS n, max(high) AS high FROM
            (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM new{b}) GROUP BY user_id, g)""")
        wm = _bound(str(b - 1))
        out.append(f"SELECT * FROM mrg{b} WHERE e <= {wm}")
        state = f"SELECT * FROM mrg{b} WHERE e <= {wm} IS NOT TRUE"
    return f"WITH {_A}, {', '.join(parts)} SELECT s AS start, e AS \"end\", user_id, n, high FROM (" + " UNION ALL ".join(out) + ")"


ORACLES = {
    "t07_tumbling": f"""WITH {_A}, w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) AS start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS "end" FROM a)
        SELECT start, "end", event_type, count(*) AS n, min(value) AS low, max(value) AS high FROM w JOIN late_by USING (arrival)
        WHERE {_OPEN} AND "end" <= {_DONE} GROUP BY ALL""",
    "t07_sliding": f"""WITH {_A}, w AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts) - to_hours(6 * k) AS start FROM a, range(4) t(k)),
        x AS (SELECT *, start + INTERVAL 24 HOUR AS "end" FROM w)
        SELECT start, "end", count(*) AS n, max(value) AS high FROM x JOIN late_by USING (arrival) WHERE {_OPEN} AND "end" <= {_DONE} GROUP BY ALL""",
    "t07_sessions": _session_sql(),
    "t07_late_events": f"""WITH {_A}, w AS (SELECT arrival, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS "end" FROM a)
        SELECT arrival, count(*) AS n, count(*) FILTER (WHERE "end" <= bound) AS n_late FROM w JOIN late_by USING (arrival) GROUP BY 1""",
}

QUERIES = {f.__name__: f for f in (t07_tumbling, t07_sliding, t07_sessions, t07_late_events)}
