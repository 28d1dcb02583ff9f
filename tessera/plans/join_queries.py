"""

The orders' dates are moved into the month of the events, so that the two tables meet in time.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import asof, difference, ranges
from tessera.sources.tables import Tables

MONTH = "2024-01-01 00:00:00"


def orders_in_month(spark, d):
    """Orders as (order_id, user_id, total, ordered, until): a day of the events' month by the order's date, a second
    of it by its key, valid for 1 to 10 minutes."""
    day = F.pmod(F.date_diff(F.to_date("o_orderdate"), F.to_date(F.lit("1995-01-01"))), F.lit(31))
    second = F.pmod(F.col("o_orderkey") * 7919, F.lit(86400))
    at = F.lit(MONTH).cast("timestamp_ntz") + F.make_dt_interval(days=day, secs=second.cast("decimal(18,6)"))
    until = F.col("ordered") + F.make_dt_interval(mins=(F.col("order_id") % 10 + 1).cast("int"))
    return Tables(spark, d).orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                                          F.col("o_totalprice").alias("total"), at.alias("ordered")).withColumn("until", until)


def j01_asof_order_event(spark, d):
    """Each order with its user's latest earlier event."""
    events = Tables(spark, d).events.select("user_id", "event_id", "ts", "event_type", "value")
    out = asof.asof_join(orders_in_month(spark, d), events, ["user_id"], "ordered", "ts", ties=["event_id"])
    return out.select("order_id", "user_id", "event_id", "event_type", "value")


def j01_asof_next_purchase(spark, d):
    """Each click with its user's next purchase within two days, the same instant included."""
    events = Tables(spark, d).events
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    buys = events.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("buy_id"), F.col("ts").alias("bought"), "value")
    out = asof.asof_join(clicks, buys, ["user_id"], "ts", "bought", ties=["buy_id"], allow_equal=True, direction="forward",
                         tolerance=F.make_dt_interval(days=F.lit(2)))
    return out.select("event_id", "buy_id", "value")


def j01_asof_turns(spark, d):
    """Each assistant turn with its conversation's latest earlier user turn."""
    turns = Tables(spark, d).conversations
    asked = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("user_turn"), F.length("text").alias("user_chars"))
    out = asof.asof_join(turns.where("role = 'assistant'").select("conv_id", "turn"), asked, ["conv_id"], "turn", "user_turn")
    return out.select("conv_id", "turn", "user_turn", F.col("user_chars").cast("long").alias("user_chars"))


def j02_events_in_orders(spark, d):
    """Per event the orders valid at its instant, whoever placed them: their number and lowest and highest id."""
    events = Tables(spark, d).events.select("event_id", "ts")
    met = ranges.points_in_ranges(events, orders_in_month(spark, d).select("order_id", "ordered", "until"), "ts", "ordered", "until", prefix="")
    return met.groupBy("event_id").agg(F.count(F.lit(1)).alias("n_orders"), F.min("order_id").alias("first_order"), F.max("order_id").alias("last_order"))


def j02_order_overlaps(spark, d):
    """Pairs of orders of one customer within two hours to a day of each other: ranges of mixed lengths."""
    hours = F.make_dt_interval(hours=F.when(F.col("order_id") % 5 == 0, 24).otherwise(2))
    o = orders_in_month(spark, d).select("order_id", "user_id", F.col("ordered").alias("a"), (F.col("ordered") + hours).alias("b"))
    met = ranges.overlaps(o, o, ("a", "b"), ("a", "b"), ["user_id"]).where("order_id < other_order_id")
    return met.select("user_id", F.col("order_id").alias("order_1"), F.col("other_order_id").alias("order_2"))


def j02_turn_context(spark, d):
    """Each assistant turn with the user turns among the three turns before it."""
    turns = Tables(spark, d).conversations
    answers = turns.where("role = 'assistant'").select("conv_id", "turn", (F.col("turn") - 3).alias("since"))
    asked = turns.where("role = 'user'").select("conv_id", F.col("turn").alias("user_turn"))
    met = ranges.points_in_ranges(asked, answers, "user_turn", "since", "turn", ["conv_id"])
    return met.select("conv_id", F.col("range_turn").alias("turn"), "user_turn")


def _versions(spark, d):
    """The orders, and a later version of them: some gone, some with another price, some twice, some new, some without a key."""
    old = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_totalprice")
    k = F.col("o_orderkey")
    kept = old.where(k % 17 != 0).withColumn("o_totalprice", F.when(k % 13 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    lost = kept.withColumn("o_orderkey", F.when(k % 1009 != 5, k))
    new = old.where(k % 19 == 0).withColumn("o_orderkey", -k - 1)
    return old, lost.unionByName(kept.where(k % 97 == 0)).unionByName(new)


def j03_difference(spark, d):
    """What changed between the two versions of the orders."""
    return difference.difference(*_versions(spark, d), ["o_orderkey"])


def j03_applied(spark, d):
    """The old version with the difference applied."""
    old, new = _versions(spark, d)
    return difference.apply(old, difference.difference(old, new, ["o_orderkey"]))


_ORDERS = f"""o AS (SELECT o_orderkey AS order_id, o_custkey AS user_id, o_totalprice AS total, TIMESTAMP '{MONTH}'
    + to_days(CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 31 AS INTEGER)) + to_seconds((o_orderkey * 7919) % 86400) AS ordered FROM orders),
    v AS (SELECT *, ordered + to_minutes(order_id % 10 + 1) AS until FROM o)"""

_NEW = """b AS (SELECT CASE WHEN o_orderkey % 1009 = 5 THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey, o_totalprice FROM kept
    UNION ALL SELECT * FROM kept WHERE o_orderkey % 97 = 0 UNION ALL SELECT -o_orderkey - 1, o_custkey, o_totalprice FROM a WHERE o_orderkey % 19 = 0)"""
_VERSIONS = f"""a AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders),
    kept AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM a WHERE o_orderkey % 17 <> 0), {_NEW}"""

ORACLES = {
    "j03_difference": f"""WITH {_VERSIONS}, u AS (SELECT *, 1 AS o, 0 AS n FROM a UNION ALL SELECT *, 0, 1 FROM b),
        r AS (SELECT o_orderkey, o_custkey, o_totalprice, sum(o) AS o, sum(n) AS n FROM u GROUP BY 1, 2, 3),
        w AS (SELECT *, sum(o) OVER (PARTITION BY o_orderkey) AS os, sum(n) OVER (PARTITION BY o_orderkey) AS ns FROM r)
        SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN os > 1 OR ns > 1 THEN 'repeated' WHEN os = 0 THEN 'insert' WHEN ns = 0 THEN 'delete'
          WHEN o = 1 THEN 'update_from' ELSE 'update_to' END AS change, CAST(n - o AS BIGINT) AS copies FROM w WHERE n <> o""",
    "j03_applied": f"WITH {_VERSIONS} SELECT * FROM b",
    "j01_asof_order_event": f"""WITH {_ORDERS}, m AS (SELECT order_id, user_id, (SELECT max(e.ts) FROM events e WHERE e.user_id = v.user_id AND e.ts < v.ordered) AS at FROM v)
        SELECT order_id, m.user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type, max_by(value, event_id) AS value
        FROM m LEFT JOIN events e ON e.user_id = m.user_id AND e.ts = m.at GROUP BY 1, 2""",
    "j01_asof_next_purchase": """WITH b AS (SELECT user_id, event_id, ts, value FROM events WHERE event_type = 'purchase'),
        m AS (SELECT event_id, user_id, (SELECT min(b.ts) FROM b WHERE b.user_id = e.user_id AND b.ts >= e.ts AND b.ts <= e.ts + INTERVAL 2 DAY) AS at
              FROM events e WHERE event_type = 'click')
        SELECT m.event_id, max(b.event_id) AS buy_id, max_by(b.value, b.event_id) AS value
        FROM m LEFT JOIN b ON b.user_id = m.user_id AND b.ts = m.at GROUP BY 1""",
    "j01_asof_turns": """WITH u AS (SELECT conv_id, turn, length(text) AS n FROM conversations WHERE role = 'user'),
        a AS (SELECT conv_id, turn, (SELECT max(u.turn) FROM u WHERE u.conv_id = c.conv_id AND u.turn < c.turn) AS user_turn
              FROM conversations c WHERE role = 'assistant')
        SELECT a.conv_id, a.turn, a.user_turn, (SELECT max(n) FROM u WHERE u.conv_id = a.conv_id AND u.turn = a.user_turn) AS user_chars FROM a""",
    "j02_events_in_orders": f"""WITH {_ORDERS} SELECT event_id, count(*) AS n_orders, min(order_id) AS first_order, max(order_id) AS last_order
        FROM events JOIN v ON ordered <= ts AND ts < until GROUP BY 1""",
    "j02_order_overlaps": f"""WITH {_ORDERS}, r AS (SELECT order_id, user_id, ordered AS a, ordered + to_hours(CASE WHEN order_id % 5 = 0 THEN 24 ELSE 2 END) AS b FROM v)
        SELECT x.user_id, x.order_id AS order_1, y.order_id AS order_2 FROM r x JOIN r y ON x.user_id = y.user_id AND x.order_id < y.order_id
        WHERE x.a < y.b AND y.a < x.b""",
    "j02_turn_context": """SELECT a.conv_id, a.turn, u.turn AS user_turn FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id
        AND u.turn >= a.turn - 3 AND u.turn < a.turn WHERE a.role = 'assistant' AND u.role = 'user'""",
}

QUERIES = {f.__name__: f for f in (j01_asof_order_event, j01_asof_next_purchase, j01_asof_turns, j02_events_in_orders, j02_order_overlaps,
                                   j02_turn_context, j03_difference, j03_applied)}
