"""Registered incremental queries (S2, T1–T6): each runs its stream to completion with
``availableNow`` into Parquet under the shared folder and returns the table read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.clean import strip_ws
from tessera.plans.profile_queries import CUSTOMER_COLUMNS
from tessera.session import shared_dir
from tessera.sources import views
from tessera.plans.store_queries import STORE_LINKS, STORE_LOOP
from tessera.streaming import incremental as T
from tessera.streaming.event_time import arrive
from tessera.streaming.store_state import stream_stores


def _events(spark, d):
    return T.event_stream(spark, d)


def _counts_table(spark, d, key_expr, name):
    s = _events(spark, d).select(key_expr.alias("key"))
    path = T.run_to_table(T.running_counts(s, "key"), shared_dir(spark, name), "complete", name)
    return T.latest(spark, path)


def s02_incremental_scan(spark, d):
    path = T.run_to_table(_events(spark, d).select("event_id", "user_id", "event_type"),
                          shared_dir(spark, "s02"), "append", "s02")
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


def t01_running_counts(spark, d):
    return _counts_table(spark, d, F.col("event_type"), "t01").select(
        F.col("key").alias("event_type"), "count")


def t02_running_nulls(spark, d):
    path = T.run_to_table(T.running_nulls(_events(spark, d)), shared_dir(spark, "t02"), "complete", "t02")
    return T.latest(spark, path)


def t03_running_distinct(spark, d):
    path = T.run_to_table(T.running_distinct(_events(spark, d), "user_id"), shared_dir(spark, "t03"),
                          "complete", "t03")
    return T.latest(spark, path)


def t04_batch_validation(spark, d):
    valid = F.col("user_id").isNotNull() & F.col("event_type").isNotNull() & (F.trim("event_type") != "")
    path = T.per_batch_validation(_events(spark, d), shared_dir(spark, "t04"), "event_id", "ts", valid, "t04")
    return T.totals_from_batches(spark, path).select("rows_in", "processed", "failed")


def t05_top_event_types(spark, d):
    return T.top_from_state(t01_running_counts(spark, d), "event_type", 3)


def t05_busiest_days(spark, d):
    counts = _counts_table(spark, d, F.date_format("ts", "yyyy-MM-dd"), "t05").select(
        F.col("key").alias("day"), "count")
    return T.top_from_state(counts, "day", 12)


def t06_stream_equals_batch(spark, d):
    agg = _events(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                                      F.round(F.sum("value"), 4).alias("value_sum"))
    path = T.run_to_table(agg, shared_dir(spark, "t06"), "complete", "t06")
    return T.latest(spark, path)


CHUNKS = 5  # files the customers arrive in


def _customers(spark, d, columns=CUSTOMER_COLUMNS):
    """The customers as a stream of files by position: repeated ids and bad rows within and across them."""
    c = views.customers_v(spark, d)
    c = c.withColumn("chunk", F.pmod(F.floor(F.col("idx") / 7), F.lit(CHUNKS)).cast("int"))
    folder = shared_dir(spark, "customer_chunks")
    c.repartition("chunk").write.partitionBy("chunk").parquet(folder)
    return T.file_stream(spark, folder, c.schema).select(*columns)


def _customer_counts(spark, d):
    counts = T.customer_counters(_customers(spark, d)).groupBy("counter", "value").agg(F.count(F.lit(1)).alias("count"))
    return T.latest(spark, T.run_to_table(counts, shared_dir(spark, "t01c"), "complete", "t01c"))


def _customer_flags(spark, d):
    flags = T.running_nulls(_customers(spark, d), "phone_1")
    return T.latest(spark, T.run_to_table(flags, shared_dir(spark, "t02c"), "complete", "t02c"))


def _customer_ids(spark, d):
    ids = T.running_distinct(_customers(spark, d, ["customer_id"]), "customer_id")
    return T.latest(spark, T.run_to_table(ids, shared_dir(spark, "t03c"), "complete", "t03c"))


def t01_customer_counters(spark, d):
    return _customer_counts(spark, d)


def t02_customer_flags(spark, d):
    return _customer_flags(spark, d)


def t03_distinct_customers(spark, d):
    return _customer_ids(spark, d)


def t04_customer_batches(spark, d):
    """Per micro-batch (file): rows, valid and failed rows after keeping the batch's first row of each id."""
    valid = F.coalesce((strip_ws("customer_id") != "") & F.col("email").contains("@"), F.lit(False))
    path = T.per_batch_validation(_customers(spark, d), shared_dir(spark, "t04c"), "customer_id", "idx", valid, "t04c")
    return T.totals_from_batches(spark, path)


def t05_accumulated_report(spark, d):
    schema = views.customers_v(spark, d).select(*CUSTOMER_COLUMNS).schema
    return T.accumulated_report(_customer_counts(spark, d), _customer_flags(spark, d), _customer_ids(spark, d), t04_customer_batches(spark, d), schema)


def t08_streamed_stores(spark, d):
    """Receipts arriving in five parts: each with its store, found or created, and a new store's name."""
    receipts, parts = views.store_receipts_v(spark, d), F.lit(CHUNKS)
    top = receipts.select(F.max("receipt_id") + 1).scalar()
    arriving = arrive(receipts.withColumn("arrival", F.floor(F.col("receipt_id") * parts / top).cast("int")), "arrival", "receipt_id",
                      shared_dir(spark, "receipt-arrivals"), 4)
    results = stream_stores(arriving, views.stores_v(spark, d))
    new = results.read("new").select(F.col("id").alias("store_id"), F.col("name").alias("new_name"))
    return results.read("links").join(new, "store_id", "left").select("receipt_id", "store_id", "new_name")


_NULLS = ", ".join(f"count(*) - count({c}) AS null_{c}" for c in
                   ["event_id", "ts", "user_id", "event_type", "value", "props"])

_DAY = "CAST(try_strptime(subscription_date, '%Y-%m-%d') AS DATE)"
_COUNTED = {
    "countries": "country", "companies": "company", "email_domains": "nullif(split_part(lower(email), '@', 2), '')",
    "years": f"CAST(year({_DAY}) AS VARCHAR)", "months": f"strftime({_DAY}, '%Y-%m')",
    "seasons": f"CASE WHEN month({_DAY}) IN (12, 1, 2) THEN 'Winter' WHEN month({_DAY}) IN (3, 4, 5) THEN 'Spring' "
               f"WHEN month({_DAY}) IN (6, 7, 8) THEN 'Summer' WHEN month({_DAY}) IN (9, 10, 11) THEN 'Fall' END",
    "website_domains": "nullif(regexp_extract(website, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '')",
}
_COUNTERS = " UNION ALL ".join(
    f"SELECT '{k}' AS counter, {v} AS value, count(*) AS count FROM customers_v WHERE {v} IS NOT NULL GROUP BY 2" for k, v in _COUNTED.items())
_CNULLS = ", ".join(f"count(*) - count({c}) AS null_{c}" for c in CUSTOMER_COLUMNS)
_FLAGS = f"""SELECT count(*) AS total_rows, {_CNULLS}, count(phone_1) AS phones_total,
    count(*) FILTER (WHERE starts_with(phone_1, '+')) AS phones_international,
    count(*) FILTER (WHERE contains(phone_1, 'x')) AS phones_extensions FROM customers_v"""
_MISSING = " + ".join(f"null_{c}" for c in CUSTOMER_COLUMNS)
_REPORT_ROWS = {
    ("summary", "total_records"): "total_rows", ("summary", "chunks_processed"): str(CHUNKS), ("summary", "unique_customers"): "ids",
    ("columns", "total_columns"): str(len(CUSTOMER_COLUMNS)),
    **{("columns", f"{c}: {'bigint' if c == 'idx' else 'string'}"): str(i) for i, c in enumerate(CUSTOMER_COLUMNS)},
    ("quality", "total_rows"): "total_rows", ("quality", "missing_values"): _MISSING, ("quality", "duplicate_count"): "total_rows - ids",
    ("quality", "unique_customers"): "ids",
    ("quality", "completeness_score"): f"round((total_rows * {len(CUSTOMER_COLUMNS)} - ({_MISSING})) * 100.0 / (total_rows * {len(CUSTOMER_COLUMNS)}), 4)",
    **{("phone_patterns", c): f"phones_{c}" for c in ("total", "international", "extensions")},
    **{("missing_values", c): f"null_{c}" for c in CUSTOMER_COLUMNS},
}
_REPORT = f"""WITH c AS ({_COUNTERS}), f AS (SELECT *, (SELECT count(DISTINCT customer_id) FROM customers_v) AS ids FROM ({_FLAGS})),
    r AS (SELECT *, row_number() OVER (PARTITION BY counter ORDER BY count DESC, value) AS rn FROM c)
    SELECT counter AS section, value AS name, CAST(count AS DOUBLE) AS value FROM r WHERE rn <= CASE counter WHEN 'countries' THEN 15
      WHEN 'companies' THEN 15 WHEN 'email_domains' THEN 15 WHEN 'website_domains' THEN 10 WHEN 'months' THEN 12 ELSE 1000000 END
    UNION ALL SELECT 'market_penetration', value, round(count * 100.0 / (SELECT total_rows FROM f), 4) FROM r WHERE counter = 'countries' AND rn <= 10
    UNION ALL """ + " UNION ALL ".join(f"SELECT '{a}', '{b}', CAST({v} AS DOUBLE) FROM f" for (a, b), v in _REPORT_ROWS.items())
_BATCHES = f"""SELECT CAST((SELECT count(*) FROM customers_v) AS BIGINT) AS rows_in,
    count(*) FILTER (WHERE ok) AS processed, count(*) FILTER (WHERE NOT ok) AS failed, count(DISTINCT chunk) AS batches
    FROM (SELECT chunk, coalesce(trim(customer_id) <> '' AND contains(email, '@'), false) AS ok
          FROM (SELECT *, row_number() OVER (PARTITION BY chunk, customer_id ORDER BY idx) AS rn
                FROM (SELECT *, CAST(idx // 7 AS BIGINT) % {CHUNKS} AS chunk FROM customers_v)) WHERE rn = 1)"""

ORACLES = {
    "t08_streamed_stores": STORE_LOOP + f"""SELECT l.receipt_id, l.store_id, n.name AS new_name
        FROM {STORE_LINKS} l LEFT JOIN new_stores n ON n.id = l.store_id""",
    "t01_customer_counters": _COUNTERS,
    "t02_customer_flags": _FLAGS,
    "t03_distinct_customers": "SELECT count(DISTINCT customer_id) AS distinct_keys FROM customers_v",
    "t04_customer_batches": _BATCHES,
    "t05_accumulated_report": _REPORT,
    "s02_incremental_scan": "SELECT event_id, user_id, event_type FROM events",
    "t01_running_counts": "SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL GROUP BY 1",
    "t02_running_nulls": f"SELECT count(*) AS total_rows, {_NULLS} FROM events",
    "t03_running_distinct": "SELECT count(DISTINCT user_id) AS distinct_keys FROM events",
    "t04_batch_validation": """SELECT count(*) AS rows_in,
        count(*) FILTER (WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND trim(event_type) <> '') AS processed,
        count(*) FILTER (WHERE NOT (user_id IS NOT NULL AND event_type IS NOT NULL AND trim(event_type) <> ''))
          AS failed FROM events""",
    "t05_top_event_types": """SELECT event_type, count(*) AS count FROM events WHERE event_type IS NOT NULL
        GROUP BY 1 ORDER BY count DESC, event_type LIMIT 3""",
    "t05_busiest_days": """SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS count FROM events GROUP BY 1
        ORDER BY count DESC, day LIMIT 12""",
    "t06_stream_equals_batch": """SELECT event_type, count(*) AS n, round(sum(value), 4) AS value_sum FROM events
        GROUP BY 1""",
}

QUERIES = {
    "t08_streamed_stores": t08_streamed_stores,
    "t01_customer_counters": t01_customer_counters,
    "t02_customer_flags": t02_customer_flags,
    "t03_distinct_customers": t03_distinct_customers,
    "t04_customer_batches": t04_customer_batches,
    "t05_accumulated_report": t05_accumulated_report,
    "s02_incremental_scan": s02_incremental_scan,
    "t01_running_counts": t01_running_counts,
    "t02_running_nulls": t02_running_nulls,
    "t03_running_distinct": t03_running_distinct,
    "t04_batch_validation": t04_batch_validation,
    "t05_top_event_types": t05_top_event_types,
    "t05_busiest_days": t05_busiest_days,
    "t06_stream_equals_batch": t06_stream_equals_batch,
}
