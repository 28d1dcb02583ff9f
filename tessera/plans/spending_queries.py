"""Registered spending-analytics queries (A1–A21) and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import spending as A
from tessera.sources import views

R4 = 4


def _r(spark, d):
    return views.receipts_v(spark, d)


def _i(spark, d):
    return views.items_v(spark, d)


def _date(c="receipt_date"):
    return F.col(c).cast("date").alias(c)


def _round(*cols):
    return [F.round(c, R4).alias(c) for c in cols]


def a01_recent_receipts(spark, d):
    return A.newest(_r(spark, d)).select("receipt_id", "store_name", _date(), *_round("total_amount"))


def _recent_items(spark, d):
    return A.items_of(A.newest(_r(spark, d)), _i(spark, d))


def a02_recent_items(spark, d):
    return _recent_items(spark, d).select("receipt_id", "line_no", "part_id", "item_name", *_round("total_price"))


def _combined(spark, d):
    return A.combined_rows(A.newest(_r(spark, d)), _recent_items(spark, d))


def a03_combined_rows(spark, d):
    return _combined(spark, d).select("receipt_id", "store_name", "item_name", *_round("item_price"))


def a04_collapse(spark, d):
    return A.collapse(_combined(spark, d)).select("receipt_id", "store_name", _date(), *_round("total_amount"))


def a05_totals(spark, d):
    return A.totals(_r(spark, d)).select("total_receipts", "unique_stores",
                                         *_round("total_spent", "average_per_receipt"))


def a06_top_stores(spark, d):
    return A.top_stores(_r(spark, d)).select("store_name", "visits", *_round("spent"))


def a07_store_visits(spark, d):
    return A.store_visits(_r(spark, d))


def a08_store_average(spark, d):
    return A.store_average(_r(spark, d)).select("store_name", "visits", *_round("spent", "avg_per_visit"))


def a08_favourite_store(spark, d):
    return A.favourite_store(_r(spark, d)).select("store_name", *_round("spent"))


def a09_top_items(spark, d):
    return A.top_items(_i(spark, d)).select("item_name", *_round("spent"))


def a10_top_categories(spark, d):
    return A.top_categories_by_rows(_i(spark, d))


def a11_daily_spending(spark, d):
    return A.daily_spending(_r(spark, d)).select("day", *_round("amount"))


def a12_spending_range(spark, d):
    return A.spending_range(_r(spark, d)).select(*_round("min_receipt", "max_receipt"))


def a13_date_range(spark, d):
    return A.date_span(_r(spark, d)).select(_date("start"), _date("end"))


def a14_top_store_gap(spark, d):
    return A.top_store_gap(_r(spark, d)).select("top_store", "second_store", *_round("difference"))


def a15_recent_timeline(spark, d):
    return A.recent_timeline(_r(spark, d)).select("day", *_round("amount"))


def a15_last_seven_days(spark, d):
    return A.last_seven_days_total(_r(spark, d)).select(*_round("last_7_days"))


def a16_receipt_sample(spark, d):
    return A.receipt_sample(_combined(spark, d)).select("receipt_id", "store_name", _date(),
                                                        *_round("total_amount"))


def a17_period_analytics(spark, d):
    return A.period_analytics(_r(spark, d)).select("transaction_count", "period_days",
                                                   *_round("total_spent", "average_transaction"))


def a18_top_categories_spend(spark, d):
    return A.top_categories_by_spend(_r(spark, d), _i(spark, d)).select("category", *_round("amount"))


def _nested_out(df):
    text = F.array_join(F.transform("items", lambda x: F.concat(x["line_no"].cast("string"), F.lit(":"),
                                                                 x["item_name"])), "|")
    return df.select("receipt_id", "store_name", _date(), *_round("total_amount"),
                     F.size("items").alias("n_items"), text.alias("items_text"))


def a19_receipts_page(spark, d):
    return _nested_out(A.receipts_page(_r(spark, d), _i(spark, d), skip=0, limit=100))


def a19_receipts_page_2(spark, d):
    return _nested_out(A.receipts_page(_r(spark, d), _i(spark, d), skip=100, limit=50))


def a20_one_receipt(spark, d):
    return _nested_out(A.one_receipt(_r(spark, d), _i(spark, d), 7))


def a21_answer_lines(spark, d):
    return A.answer_lines(_r(spark, d))


def a21_summary_lines(spark, d):
    return A.summary_lines(_r(spark, d))


def a21_item_lines(spark, d):
    return A.item_lines(_i(spark, d))


def a21_timeline_lines(spark, d):
    return A.timeline_lines(_r(spark, d))


def a21_comparison_lines(spark, d):
    return A.comparison_lines(_r(spark, d))


# --- oracles ---------------------------------------------------------------------------

_NEWEST = "(SELECT * FROM receipts_v ORDER BY receipt_date DESC, receipt_id DESC LIMIT 100)"
_RITEMS = f"""(SELECT i.*, r.store_name, r.receipt_date, r.total_amount FROM items_v i JOIN {_NEWEST} r
    ON i.receipt_id = r.receipt_id)"""
_COMBINED = f"""(SELECT receipt_id, store_name, receipt_date, total_amount, NULL AS item_name, NULL::DOUBLE AS item_price
    FROM {_NEWEST} UNION ALL SELECT receipt_id, store_name, receipt_date, total_amount, item_name,
    total_price AS item_price FROM {_RITEMS})"""
_PAID = "total_amount IS NOT NULL AND total_amount <> 0"
_STORES = f"""(SELECT store_name, coalesce(sum(total_amount) FILTER (WHERE {_PAID}), 0.0) AS spent,
    count(DISTINCT receipt_id) AS visits, count(*) FILTER (WHERE {_PAID}) AS paid
    FROM receipts_v WHERE receipt_id IS NOT NULL AND store_name IS NOT NULL AND store_name <> '' GROUP BY store_name)"""
_TOP5 = f"(SELECT store_name, spent, visits FROM {_STORES} WHERE paid > 0 ORDER BY spent DESC, store_name LIMIT 5)"
_DAILY = f"""(SELECT CAST(receipt_date AS DATE) AS day, sum(total_amount) AS amount FROM receipts_v
    WHERE receipt_id IS NOT NULL AND {_PAID} GROUP BY 1)"""


def _money(x: str) -> str:
    return f"'$' || CAST(CAST(round(CAST({x} AS DECIMAL(38,6)), 2) AS DECIMAL(38,2)) AS VARCHAR)"


def _nested(receipts: str) -> str:
    return f"""SELECT r.receipt_id, r.store_name, CAST(r.receipt_date AS DATE) AS receipt_date,
        round(r.total_amount, 4) AS total_amount, CAST(count(i.receipt_id) AS INTEGER) AS n_items,
        coalesce(string_agg(CAST(i.line_no AS VARCHAR) || ':' || i.item_name, '|'
          ORDER BY i.line_no, i.part_id, i.total_price, i.item_name, i.quantity, i.category), '') AS items_text
        FROM {receipts} r LEFT JOIN items_v i ON i.receipt_id = r.receipt_id
        GROUP BY r.receipt_id, r.store_name, r.receipt_date, r.total_amount"""


_TOTALS = f"""(SELECT count(DISTINCT receipt_id) AS total_receipts,
    coalesce(sum(total_amount) FILTER (WHERE {_PAID}), 0.0) AS total_spent,
    count(DISTINCT store_name) FILTER (WHERE {_PAID} AND store_name IS NOT NULL AND store_name <> '') AS unique_stores
    FROM receipts_v WHERE receipt_id IS NOT NULL)"""

ORACLES = {
    "a01_recent_receipts": f"""SELECT receipt_id, store_name, CAST(receipt_date AS DATE) AS receipt_date,
        round(total_amount, 4) AS total_amount FROM {_NEWEST}""",
    "a02_recent_items": f"""SELECT receipt_id, line_no, part_id, item_name, round(total_price, 4) AS total_price
        FROM {_RITEMS}""",
    "a03_combined_rows": f"""SELECT receipt_id, store_name, item_name, round(item_price, 4) AS item_price
        FROM {_COMBINED}""",
    "a04_collapse": f"""SELECT receipt_id, max(store_name) AS store_name, CAST(max(receipt_date) AS DATE) AS receipt_date,
        round(max(total_amount), 4) AS total_amount FROM {_COMBINED} GROUP BY receipt_id""",
    "a05_totals": f"""SELECT total_receipts, unique_stores, round(total_spent, 4) AS total_spent,
        round(coalesce(total_spent / nullif(total_receipts, 0), 0.0), 4) AS average_per_receipt FROM {_TOTALS}""",
    "a06_top_stores": f"SELECT store_name, visits, round(spent, 4) AS spent FROM {_TOP5}",
    "a07_store_visits": f"SELECT store_name, visits FROM {_STORES}",
    "a08_store_average": f"""SELECT store_name, visits, round(spent, 4) AS spent,
        round(spent / visits, 4) AS avg_per_visit FROM {_TOP5}""",
    "a08_favourite_store": f"""SELECT store_name, round(spent, 4) AS spent FROM {_TOP5}
        ORDER BY spent DESC, store_name LIMIT 1""",
    "a09_top_items": """SELECT item_name, round(sum(total_price), 4) AS spent FROM items_v
        WHERE item_name IS NOT NULL AND item_name <> '' AND total_price IS NOT NULL AND total_price <> 0
        GROUP BY item_name ORDER BY sum(total_price) DESC, item_name LIMIT 10""",
    "a10_top_categories": """SELECT category, count(*) AS items FROM items_v WHERE category IS NOT NULL
        AND category <> '' GROUP BY category ORDER BY items DESC, category LIMIT 5""",
    "a11_daily_spending": f"SELECT day, round(amount, 4) AS amount FROM {_DAILY}",
    "a12_spending_range": f"""SELECT round(coalesce(min(total_amount), 0.0), 4) AS min_receipt,
        round(coalesce(max(total_amount), 0.0), 4) AS max_receipt FROM receipts_v
        WHERE receipt_id IS NOT NULL AND {_PAID}""",
    "a13_date_range": """SELECT CAST(min(receipt_date) AS DATE) AS start, CAST(max(receipt_date) AS DATE) AS "end"
        FROM receipts_v""",
    "a14_top_store_gap": f"""SELECT top_store, second_store, round(difference, 4) AS difference FROM (
        SELECT store_name AS top_store, lead(store_name) OVER w AS second_store,
          spent - lead(spent) OVER w AS difference, row_number() OVER w AS rank
        FROM {_TOP5} WINDOW w AS (ORDER BY spent DESC, store_name)) WHERE rank = 1 AND second_store IS NOT NULL""",
    "a15_recent_timeline": f"SELECT day, round(amount, 4) AS amount FROM {_DAILY} ORDER BY day DESC LIMIT 10",
    "a15_last_seven_days": f"""SELECT round(CASE WHEN count(*) >= 7 THEN sum(amount) END, 4) AS last_7_days
        FROM (SELECT * FROM {_DAILY} ORDER BY day DESC LIMIT 7)""",
    "a16_receipt_sample": f"""SELECT receipt_id, store_name, CAST(receipt_date AS DATE) AS receipt_date,
        round(total_amount, 4) AS total_amount FROM (SELECT receipt_id, max(store_name) AS store_name,
        max(receipt_date) AS receipt_date, max(total_amount) AS total_amount FROM {_COMBINED} GROUP BY receipt_id)
        ORDER BY receipt_date DESC, receipt_id DESC LIMIT 10""",
    "a17_period_analytics": """SELECT count(*) AS transaction_count, 30 AS period_days,
        round(coalesce(sum(total_amount), 0.0), 4) AS total_spent,
        round(coalesce(avg(total_amount), 0.0), 4) AS average_transaction FROM receipts_v""",
    "a18_top_categories_spend": """SELECT category, round(sum(total_price), 4) AS amount FROM items_v
        WHERE receipt_id IN (SELECT receipt_id FROM receipts_v) AND category IS NOT NULL AND category <> ''
        GROUP BY category ORDER BY sum(total_price) DESC, category LIMIT 5""",
    "a19_receipts_page": _nested(
        "(SELECT * FROM receipts_v ORDER BY receipt_date DESC, receipt_id DESC LIMIT 100 OFFSET 0)"),
    "a19_receipts_page_2": _nested(
        "(SELECT * FROM receipts_v ORDER BY receipt_date DESC, receipt_id DESC LIMIT 50 OFFSET 100)"),
    "a20_one_receipt": _nested("(SELECT * FROM receipts_v WHERE receipt_id = 7)"),
    "a21_summary_lines": f"""SELECT CAST(k AS INTEGER) AS line_no, CASE k
          WHEN 1 THEN '\u2022 **Total spent**: ' || {_money('t.total_spent')}
          WHEN 2 THEN '\u2022 **Number of receipts**: ' || CAST(t.total_receipts AS VARCHAR)
          WHEN 3 THEN '\u2022 **Average per receipt**: ' || {_money('coalesce(t.total_spent / nullif(t.total_receipts, 0), 0.0)')}
          WHEN 4 THEN '\u2022 **Stores visited**: ' || CAST(t.unique_stores AS VARCHAR)
          WHEN 5 THEN (SELECT '**Top store**: ' || store_name || ' (' || {_money('spent')} || ')' FROM {_TOP5} ORDER BY spent DESC, store_name LIMIT 1)
          ELSE (SELECT '**Period**: ' || strftime(min(receipt_date), '%Y-%m-%d') || ' to ' || strftime(max(receipt_date), '%Y-%m-%d') FROM receipts_v)
          END AS line FROM {_TOTALS} t, generate_series(1, 6) g(k)""",
    "a21_item_lines": f"""SELECT CAST(row_number() OVER (ORDER BY spent DESC, item_name) AS INTEGER) AS line_no,
          '\u2022 ' || item_name || ': ' || {_money('spent')} AS line
        FROM (SELECT item_name, sum(total_price) AS spent FROM items_v WHERE item_name <> '' AND total_price <> 0 GROUP BY 1
              ORDER BY spent DESC, item_name LIMIT 10)""",
    "a21_timeline_lines": f"""SELECT CAST(row_number() OVER (ORDER BY day DESC) AS INTEGER) AS line_no,
          '\u2022 ' || strftime(day, '%B %d, %Y') || ': ' || {_money('amount')} AS line FROM (SELECT * FROM {_DAILY} ORDER BY day DESC LIMIT 10)""",
    "a21_comparison_lines": f"""SELECT CAST(k AS INTEGER) AS line_no, CASE k
          WHEN 1 THEN '\u2022 Lowest receipt: ' || (SELECT {_money('min(total_amount)')} FROM receipts_v WHERE receipt_id IS NOT NULL AND {_PAID})
          WHEN 2 THEN '\u2022 Highest receipt: ' || (SELECT {_money('max(total_amount)')} FROM receipts_v WHERE receipt_id IS NOT NULL AND {_PAID})
          WHEN 3 THEN '\u2022 Average per receipt: ' || {_money('coalesce(t.total_spent / nullif(t.total_receipts, 0), 0.0)')}
          ELSE (SELECT 'You spend **' || {_money('a.spent - b.spent')} || ' more** at ' || a.store_name || ' than at ' || b.store_name || '.'
                FROM (SELECT *, row_number() OVER (ORDER BY spent DESC, store_name) AS rn FROM {_TOP5}) a,
                     (SELECT *, row_number() OVER (ORDER BY spent DESC, store_name) AS rn FROM {_TOP5}) b WHERE a.rn = 1 AND b.rn = 2)
          END AS line FROM {_TOTALS} t, generate_series(1, 4) g(k)""",
    "a21_answer_lines": f"""SELECT 0 AS line_no, 'Based on ' || CAST(t.total_receipts AS VARCHAR) || ' receipt'
        || CASE WHEN t.total_receipts <> 1 THEN 's' ELSE '' END || ', you''ve spent **' || {_money('t.total_spent')}
        || '**' || CASE WHEN s.s IS NULL THEN '' WHEN s.s <> s.e THEN ' from ' || s.s || ' to ' || s.e
                        ELSE ' on ' || s.s END || '.' AS line
        FROM {_TOTALS} t, (SELECT strftime(min(receipt_date), '%Y-%m-%d') AS s,
                                   strftime(max(receipt_date), '%Y-%m-%d') AS e FROM receipts_v) s
        UNION ALL
        SELECT CAST(row_number() OVER (ORDER BY spent DESC, store_name) AS INTEGER) AS line_no,
          '• **' || store_name || '**: ' || {_money('spent')} || ' across ' || CAST(visits AS VARCHAR) || ' visit'
          || CASE WHEN visits <> 1 THEN 's' ELSE '' END || ' (avg: ' || {_money('spent / visits')} || ')' AS line
        FROM {_TOP5}""",
}

QUERIES = {
    "a01_recent_receipts": a01_recent_receipts,
    "a02_recent_items": a02_recent_items,
    "a03_combined_rows": a03_combined_rows,
    "a04_collapse": a04_collapse,
    "a05_totals": a05_totals,
    "a06_top_stores": a06_top_stores,
    "a07_store_visits": a07_store_visits,
    "a08_store_average": a08_store_average,
    "a08_favourite_store": a08_favourite_store,
    "a09_top_items": a09_top_items,
    "a10_top_categories": a10_top_categories,
    "a11_daily_spending": a11_daily_spending,
    "a12_spending_range": a12_spending_range,
    "a13_date_range": a13_date_range,
    "a14_top_store_gap": a14_top_store_gap,
    "a15_recent_timeline": a15_recent_timeline,
    "a15_last_seven_days": a15_last_seven_days,
    "a16_receipt_sample": a16_receipt_sample,
    "a17_period_analytics": a17_period_analytics,
    "a18_top_categories_spend": a18_top_categories_spend,
    "a19_receipts_page": a19_receipts_page,
    "a19_receipts_page_2": a19_receipts_page_2,
    "a20_one_receipt": a20_one_receipt,
    "a21_answer_lines": a21_answer_lines,
    "a21_summary_lines": a21_summary_lines,
    "a21_item_lines": a21_item_lines,
    "a21_timeline_lines": a21_timeline_lines,
    "a21_comparison_lines": a21_comparison_lines,
}
