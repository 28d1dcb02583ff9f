"""Registered question-classification queries (N1–N5) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import questions as N
from tessera.sources import views
from tessera.sources.views import AS_OF


def _q(spark, d):
    return views.questions_v(spark, d)


def n01_time_filter(spark, d):
    return _q(spark, d).select("question_id", N.time_filter(F.col("question"), AS_OF).alias("since"))


def n02_store_filter(spark, d):
    return _q(spark, d).select("question_id", N.store_filter(F.col("question")).alias("store_filter"))


def n03_amount_filter(spark, d):
    a = N.amount_filter(F.col("question"))
    return _q(spark, d).select("question_id", a["operator"].alias("amount_op"), a["value"].alias("amount_value"))


def n04_intent(spark, d):
    return _q(spark, d).select("question_id", N.intent(F.col("question")).alias("intent"))


def n05_flags(spark, d):
    q = F.col("question")
    return _q(spark, d).select("question_id", N.needs_all_data(q).alias("needs_all_data"),
                               N.needs_items(q).alias("needs_items"))


def _any_sql(phrases):
    return "(" + " OR ".join(f"contains(lower(question), '{p}')" for p in phrases) + ")"


_NOW = f"TIMESTAMP '{AS_OF}'"


def _time_sql():
    parts = [f"WHEN {_any_sql(ph)} THEN {_NOW} - INTERVAL {days} DAY" for ph, days in N.TIME_PHRASES]
    n = f"regexp_extract(lower(question), '{N.DAYS_PATTERN}', 1)"
    return (f"CASE {' '.join(parts)} WHEN contains(lower(question), 'today') THEN date_trunc('day', {_NOW}) "
            f"WHEN {n} <> '' THEN {_NOW} - to_days(CAST({n} AS INTEGER)) END")


def _store_sql():
    parts = []
    for p in N.STORE_PATTERNS:
        name = f"regexp_replace(regexp_extract(question, '(?i){p}', 1), '^\\s+|\\s+$', '', 'g')"
        parts.append(f"WHEN length({name}) > 2 THEN {name}")
    return f"CASE {' '.join(parts)} END"


def _amount_sql(field):
    parts = []
    for p, op in N.AMOUNT_PATTERNS:
        v = f"regexp_extract(lower(question), '{p}', 1)"
        parts.append(f"WHEN {v} <> '' THEN " + (f"'{op}'" if field == "op" else f"CAST({v} AS DOUBLE)"))
    return f"CASE {' '.join(parts)} END"


def _intent_sql():
    parts = [f"WHEN {_any_sql(ph)} THEN '{name}'" for name, ph in N.INTENTS]
    return f"CASE {' '.join(parts)} ELSE 'FALLBACK' END"


ORACLES = {
    "n01_time_filter": f"SELECT question_id, {_time_sql()} AS since FROM questions_v",
    "n02_store_filter": f"SELECT question_id, {_store_sql()} AS store_filter FROM questions_v",
    "n03_amount_filter": f"""SELECT question_id, {_amount_sql('op')} AS amount_op,
        {_amount_sql('value')} AS amount_value FROM questions_v""",
    "n04_intent": f"SELECT question_id, {_intent_sql()} AS intent FROM questions_v",
    "n05_flags": f"""SELECT question_id, {_any_sql(N.ALL_DATA_PHRASES)} AS needs_all_data,
        {_any_sql(N.ITEM_PHRASES)} AS needs_items FROM questions_v""",
}

QUERIES = {
    "n01_time_filter": n01_time_filter,
    "n02_store_filter": n02_store_filter,
    "n03_amount_filter": n03_amount_filter,
    "n04_intent": n04_intent,
    "n05_flags": n05_flags,
}


# --- N6 ------------------------------------------------------------------------------
from tessera.operators import question_answers as QA  # noqa: E402


def n06_question_answers(spark, d):
    out = QA.answer(views.receipts_v(spark, d), _q(spark, d), AS_OF)
    return out.select("question_id", "answer_kind", "total_receipts", "unique_stores",
                      F.round("total_spent", 4).alias("total_spent"),
                      F.round("average_per_receipt", 4).alias("average_per_receipt"))


_SEL = f"""(SELECT question_id, {_intent_sql()} AS intent, {_any_sql(N.ALL_DATA_PHRASES)} AS all_data,
    {_time_sql()} AS since, {_store_sql()} AS store_filter, {_amount_sql('op')} AS op,
    {_amount_sql('value')} AS amount_value FROM questions_v)"""
ORACLES["n06_question_answers"] = f"""
WITH q AS {_SEL},
m AS (SELECT q.question_id, q.all_data, q.since, r.receipt_id, r.receipt_date, r.store_name, r.total_amount
      FROM q JOIN receipts_v r ON q.all_data OR (
        (q.store_filter IS NULL OR contains(lower(r.store_name), lower(q.store_filter)))
        AND (q.op IS NULL OR (q.op = 'greater' AND r.total_amount > q.amount_value)
                          OR (q.op = 'less' AND r.total_amount < q.amount_value)))),
f AS (SELECT question_id, count(DISTINCT receipt_id) AS n,
        coalesce(sum(total_amount) FILTER (WHERE total_amount IS NOT NULL AND total_amount <> 0), 0.0) AS spent,
        count(DISTINCT store_name) FILTER (WHERE total_amount IS NOT NULL AND total_amount <> 0) AS stores
      FROM m WHERE (all_data OR since IS NULL OR receipt_date >= since) GROUP BY question_id)
SELECT q.question_id, CASE WHEN coalesce(f.n, 0) = 0 THEN 'NO_DATA' ELSE q.intent END AS answer_kind,
  CAST(coalesce(f.n, 0) AS BIGINT) AS total_receipts, CAST(coalesce(f.stores, 0) AS BIGINT) AS unique_stores,
  round(coalesce(f.spent, 0.0), 4) AS total_spent,
  round(CASE WHEN coalesce(f.n, 0) > 0 THEN f.spent / f.n ELSE 0.0 END, 4) AS average_per_receipt
FROM q LEFT JOIN f ON q.question_id = f.question_id"""
QUERIES["n06_question_answers"] = n06_question_answers


def n06_item_answers(spark, d):
    """Top items and categories of every question that asks for items."""
    out = QA.item_answers(views.receipts_v(spark, d), views.items_v(spark, d), _q(spark, d))
    return out.select("question_id", "kind", F.col("rank").cast("long").alias("rank"), "name", F.round("figure", 4).alias("figure"))


ORACLES["n06_item_answers"] = f"""
WITH i AS (SELECT * FROM items_v WHERE receipt_id IN (SELECT receipt_id FROM receipts_v)),
t AS (SELECT 'item' AS kind, item_name AS name, sum(total_price) AS figure, row_number() OVER (ORDER BY sum(total_price) DESC, item_name) AS rank
      FROM i WHERE item_name <> '' AND total_price <> 0 GROUP BY item_name
      UNION ALL SELECT 'category', category, count(*), row_number() OVER (ORDER BY count(*) DESC, category) FROM i WHERE category <> '' GROUP BY category)
SELECT question_id, kind, rank, name, round(figure, 4)::DOUBLE AS figure FROM questions_v, t
WHERE {_any_sql(N.ITEM_PHRASES)} AND rank <= CASE kind WHEN 'item' THEN 10 ELSE 5 END"""
QUERIES["n06_item_answers"] = n06_item_answers
