"""Registered queries on summaries of bounded size (frequent values, sets by day) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import heavy_hitters as H
from tessera.operators import set_sketches as K
from tessera.plans import stream_queries as S
from tessera.session import shared_dir
from tessera.sources import views
from tessera.sources.tables import Tables
from tessera.streaming import incremental as T
from tessera.streaming.event_time import arrive

CAPACITY, K_CUSTOMERS, K_PAGES, LAGS, LG = 64, 5, 15, 7, 9


def t09_frequent_counters(spark, d):
    """The five most frequent companies, e-mail domains and hosts of the customers' stream, by a summary of 64 each."""
    named = ["companies", "email_domains", "website_domains", "countries"]
    stream = T.customer_counters(S._customers(spark, d)).where(F.col("counter").isin(named))
    summary = H.stream_summary(stream, CAPACITY)
    pairs = T.customer_counters(views.customers_v(spark, d)).where(F.col("counter").isin(named))
    return H.top(pairs, summary, K_CUSTOMERS).select("counter", "value", "count", F.col("rank").cast("long").alias("rank"))


def _page_keys(pages):
    """Pages by host and first part of the path: far more values than a summary holds."""
    return pages.select("page_id", F.lit("sites").alias("counter"),
                        F.nullif(F.regexp_extract("url", r"^[a-z]+://([^/?#]*/[^/?#]*/[^/?#]?)", 1), F.lit("")).alias("value"))


def t09_frequent_sites(spark, d):
    """The fifteen most frequent sites of the pages, which arrive in five parts, and whether the summary's error kept its bound."""
    keys = _page_keys(Tables(spark, d).pages)
    stream = arrive(keys.withColumn("arrival", F.pmod("page_id", F.lit(5)).cast("int")), "arrival", "page_id", shared_dir(spark, "page-arrivals"), 4)
    summary = H.stream_summary(stream, CAPACITY)
    n = keys.select(F.count("value")).scalar()
    out = H.top(keys.select("counter", "value"), summary, K_PAGES)
    return out.select("value", "count", F.col("rank").cast("long").alias("rank"), (F.col("error") * (CAPACITY + 1) <= n).alias("within_bound"))


def _visits(spark, d):
    return Tables(spark, d).events.select(F.col("ts").cast("date").alias("day"), "user_id")


def t10_user_overlaps(spark, d):
    """Users of two days up to a week apart: of both, shared, lost and gained, exact."""
    return K.overlaps(_visits(spark, d), "day", "user_id", LAGS)


def t10_overlap_estimates(spark, d):
    """For the same pairs whether each size estimated from the days' sketches of 512 hashes is within its bound."""
    v = _visits(spark, d)
    exact = K.overlaps(v, "day", "user_id", LAGS)
    found = K.estimates(K.daily_sketches(v, "day", "user_id", LG), LAGS, LG)
    sizes = [c for c in exact.columns if c.startswith("n_")]
    both = found.join(exact.select("earlier", "day", *[F.col(c).alias(f"x_{c}") for c in sizes]), ["earlier", "day"], "full")
    close = [F.coalesce(F.abs(F.col(c) - F.col(f"x_{c}")) <= F.col("bound"), F.lit(False)).alias(f"{c}_close") for c in sizes]
    return both.select("earlier", "day", *close)


_TOP = f"""WITH p AS (SELECT counter, value, count FROM ({S._COUNTERS})),
    r AS (SELECT *, row_number() OVER (PARTITION BY counter ORDER BY count DESC, value) AS rank FROM p
          WHERE counter IN ('companies', 'email_domains', 'website_domains', 'countries'))
    SELECT counter, value, count, rank FROM r WHERE rank <= {K_CUSTOMERS}"""
_SEEN = """WITH s AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id FROM events WHERE user_id IS NOT NULL),
    n AS (SELECT day, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.day AS earlier, b.day AS day, a.n AS n_earlier, b.n AS n_day,
            (SELECT count(*) FROM s x JOIN s y USING (user_id) WHERE x.day = a.day AND y.day = b.day) AS n_kept
          FROM n a JOIN n b ON b.day - a.day BETWEEN 1 AND 7)"""

ORACLES = {
    "t09_frequent_counters": _TOP,
    "t09_frequent_sites": r"""WITH k AS (SELECT nullif(regexp_extract(url, '^[a-z]+://([^/?#]*/[^/?#]*/[^/?#]?)', 1), '') AS value FROM pages),
        r AS (SELECT value, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, value) AS rank FROM k WHERE value IS NOT NULL GROUP BY value)
        SELECT value, count, rank, true AS within_bound FROM r WHERE rank <= 15""",
    "t10_user_overlaps": f"""{_SEEN} SELECT earlier, day, n_earlier, n_day, n_earlier + n_day - n_kept AS n_union, n_kept,
        n_earlier - n_kept AS n_lost, n_day - n_kept AS n_gained FROM p""",
    "t10_overlap_estimates": f"""{_SEEN} SELECT earlier, day, true AS n_earlier_close, true AS n_day_close, true AS n_union_close,
        true AS n_kept_close, true AS n_lost_close, true AS n_gained_close FROM p""",
}

QUERIES = {f.__name__: f for f in (t09_frequent_counters, t09_frequent_sites, t10_user_overlaps, t10_overlap_estimates)}
