"""Registered receipt-text queries (R1–R14, S9) and their DuckDB oracles.

``receipt_text_v`` is generated from ``orders`` by a fixed template, so the oracle for
each extraction rule states the expected value per template branch (a brute-force
expectation over the same rows), while R1, R3 and R13 get a generic SQL form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import receipt_text as RT
from tessera.operators import receipts as RC
from tessera.operators.clean import strip_ws
from tessera.plans.store_queries import STORE_LINKS, STORE_LOOP
from tessera.session import shared_dir
from tessera.sources import views
from tessera.sources.tables import Tables
from tessera.sources.views import AS_OF


def _parsed(spark, d):
    return RC.parse(views.receipt_text_v(spark, d), AS_OF, partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))


def r01_clean_lines(spark, d):
    docs = Tables(spark, d).documents
    lines = RT.clean_lines(F.col("text"), fix_ocr=False)
    return docs.select("doc_id", F.size(lines).alias("n_lines"),
                       F.length(F.array_join(lines, "\n")).alias("clean_chars"))


def r02_ocr_fix(spark, d):
    t = views.receipt_text_v(spark, d)
    return t.select("doc_id", F.array_join(RT.clean_lines(F.col("raw_text")), "\n").alias("clean_text"))


def r03_best_candidate(spark, d):
    docs = Tables(spark, d).documents.select("lang", F.col("doc_id").alias("candidate_no"), "text")
    best = RC.best_candidate(docs, "lang", "text", "candidate_no")
    return best.select("lang", F.col("candidate_no").alias("doc_id"),
                       F.length(strip_ws("text")).alias("stripped_chars"))


def r04_store_name(spark, d):
    return _parsed(spark, d).select("receipt_id", "store_name")


def r05_store_address(spark, d):
    return _parsed(spark, d).select("receipt_id", "store_address")


def r06_receipt_date(spark, d):
    return _parsed(spark, d).select("receipt_id", F.col("receipt_date").cast("date").alias("receipt_date"))


def r07_total(spark, d):
    return _parsed(spark, d).select("receipt_id", F.round("total_amount", 4).alias("total_amount"))


def r08_tax_discount(spark, d):
    return _parsed(spark, d).select("receipt_id", F.round("tax_amount", 4).alias("tax_amount"),
                                    "discount_amount")


def _items(spark, d):
    return RC.items_table(_parsed(spark, d))


def r09_item_lines(spark, d):
    return _items(spark, d).select("receipt_id", "line_no")


def r10_item_names(spark, d):
    return _items(spark, d).select("receipt_id", "line_no", "item_name", F.round("total_price", 4).alias("total_price"))


def r11_quantities(spark, d):
    return _items(spark, d).select("receipt_id", "line_no", "quantity",
                                   F.round("unit_price", 4).alias("unit_price"))


def r12_accepted_items(spark, d):
    return _items(spark, d).groupBy("receipt_id").agg(F.count(F.lit(1)).alias("n_items"))


def r13_item_category(spark, d):
    p = Tables(spark, d).part
    return p.select("p_partkey", RT.item_category(F.col("p_name")).alias("category"))


def r14_parse(spark, d):
    return _parsed(spark, d).select(
        "receipt_id", "store_name", "store_address", F.col("receipt_date").cast("date").alias("receipt_date"),
        F.round("total_amount", 4).alias("total_amount"), F.round("tax_amount", 4).alias("tax_amount"),
        "discount_amount", F.size("items").alias("n_items"))


def s09_linked_receipts(spark, d):
    """The receipts half: text parsed once, stores found or created, receipts written with store_id."""
    r_path, _ = RC.write_tables(_parsed(spark, d), shared_dir(spark, "receipts"), views.stores_v(spark, d))
    return spark.read.parquet(r_path).select(
        "receipt_id", "store_id", "store_name", "store_address", F.col("receipt_date").cast("date").alias("receipt_date"),
        F.round("total_amount", 4).alias("total_amount"), F.round("tax_amount", 4).alias("tax_amount"), "discount_amount", "is_processed")


def s09_write_receipts(spark, d):
    r_path, i_path = RC.write_tables(_parsed(spark, d), shared_dir(spark, "receipts"))
    items = spark.read.parquet(i_path)
    return items.select("receipt_id", "line_no", "item_name", "quantity",
                        F.round("unit_price", 4).alias("unit_price"), F.round("total_price", 4).alias("total_price"),
                        "category")


# --- oracles ---------------------------------------------------------------------------

_K = "o_orderkey"
_DATE_LINE = (f"CASE WHEN {_K} % 8 = 0 THEN 'Date: ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) "
              f"ELSE 'Date: ' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '/' || "
              f"lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') || '/' || CAST(year(o_orderdate) AS VARCHAR) END")
_STORE = (f"CASE WHEN {_K} % 6 = 0 THEN 'Corner Family Bakery' WHEN {_K} % 6 = 1 THEN 'Sunny Mart' "
          f"ELSE 'Book Stationery ' || CAST({_K} % 12 AS VARCHAR) || ' SDN BHD' END")
_PEN = f"CAST({_K} % 4 AS VARCHAR) || ' x Pilot Pen ' || CAST({_K} % 50 + 1 AS VARCHAR) || '.50'"
_MILK = f"'Fresh Milk 1L ' || CAST({_K} % 9 + 2 AS VARCHAR) || '.20'"
_TOTAL = f"CASE WHEN {_K} % 7 = 0 THEN 10 + {_K} % 10 + 0.5 ELSE {_K} % 60 + 10 END"
_CLEAN = (f"CAST(100000 + {_K} AS VARCHAR) || chr(10) || {_STORE} || chr(10) || 'No 12 Jalan Besar' || chr(10) || "
          f"'43300 Town' || chr(10) || {_DATE_LINE} || chr(10) || {_PEN} || chr(10) || {_MILK} || chr(10) || "
          f"'Shampoo (large) $' || CAST({_K} % 7 + 5 AS VARCHAR) || '.00' || chr(10) || "
          f"'Subtotal ' || CAST({_K} % 60 + 9 AS VARCHAR) || '.70' || chr(10) || "
          f"'GST 6% ' || CAST({_K} % 3 AS VARCHAR) || '.30' || chr(10) || "
          f"CASE WHEN {_K} % 7 = 0 THEN 'TOTAL $1' || CAST({_K} % 10 AS VARCHAR) || '.50' "
          f"ELSE 'TOTAL $' || CAST({_K} % 60 + 10 AS VARCHAR) || '.00' END || chr(10) || "
          f"'CHANGE 5.00' || chr(10) || 'Thank you'")
_ADDRESS = f"'No 12 Jalan Besar, 43300 Town, ' || {_DATE_LINE} || ', ' || {_PEN} || ', ' || {_MILK}"
# 'yyyy-MM-dd' lines parse as yy-MM-dd under the reference's format order; for years 2001
# the first format that succeeds is day-month-year, giving the 1st of MM in 20DD.
_PARSED_DATE = (f"CASE WHEN {_K} % 8 = 0 AND year(o_orderdate) = 2001 "
                f"THEN make_date(2000 + day(o_orderdate), month(o_orderdate), 1) "
                f"ELSE CAST(o_orderdate AS DATE) END")
_ITEMS = f"""(
  SELECT {_K} AS receipt_id, 6 AS line_no, 'Pilot Pen' AS item_name, CAST({_K} % 4 AS DOUBLE) AS quantity,
    ({_K} % 50 + 1.5) / ({_K} % 4) AS unit_price, CAST({_K} % 50 + 1.5 AS DOUBLE) AS total_price,
    'Stationery' AS category FROM orders WHERE {_K} % 4 <> 0
  UNION ALL
  SELECT {_K}, 7, 'Fresh Milk 1L', 1.0, CAST({_K} % 9 + 2.2 AS DOUBLE), CAST({_K} % 9 + 2.2 AS DOUBLE), 'Dairy'
    FROM orders
  UNION ALL
  SELECT {_K}, 8, 'Shampoo  large', 1.0, CAST({_K} % 7 + 5 AS DOUBLE), CAST({_K} % 7 + 5 AS DOUBLE),
    'Meat & Seafood' FROM orders)"""
_WS = "'^\\s+|\\s+$'"


def _category_sql(col: str) -> str:
    parts = []
    for cat, words in RT.ITEM_CATEGORIES:
        cond = " OR ".join(f"contains(lower({col}), '{w}')" for w in words)
        parts.append(f"WHEN {cond} THEN '{cat}'")
    return f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'Other' {' '.join(parts)} ELSE 'Other' END"


ORACLES = {
    "r01_clean_lines": f"""SELECT doc_id, CAST(len(l) AS INTEGER) AS n_lines,
        CAST(length(array_to_string(l, chr(10))) AS INTEGER) AS clean_chars FROM (
        SELECT doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
          lambda x: regexp_replace(regexp_replace(x, '\\s+', ' ', 'g'), {_WS}, '', 'g')), lambda x: x <> '') AS l
        FROM documents)""",
    "r02_ocr_fix": f"SELECT {_K} AS doc_id, {_CLEAN} AS clean_text FROM orders",
    "r03_best_candidate": f"""SELECT lang, doc_id, CAST(n AS INTEGER) AS stripped_chars FROM (
        SELECT lang, doc_id, length(regexp_replace(text, {_WS}, '', 'g')) AS n,
          row_number() OVER (PARTITION BY lang ORDER BY length(regexp_replace(text, {_WS}, '', 'g')) DESC, doc_id)
          AS rn FROM documents) WHERE rn = 1""",
    "r04_store_name": f"SELECT {_K} AS receipt_id, {_STORE} AS store_name FROM orders",
    "r05_store_address": f"SELECT {_K} AS receipt_id, {_ADDRESS} AS store_address FROM orders",
    "r06_receipt_date": f"SELECT {_K} AS receipt_id, {_PARSED_DATE} AS receipt_date FROM orders",
    "r07_total": f"SELECT {_K} AS receipt_id, round(CAST({_TOTAL} AS DOUBLE), 4) AS total_amount FROM orders",
    "r08_tax_discount": f"""SELECT {_K} AS receipt_id, round(CAST({_K} % 3 + 0.3 AS DOUBLE), 4) AS tax_amount,
        0.0::DOUBLE AS discount_amount FROM orders""",
    "r09_item_lines": f"SELECT receipt_id, line_no FROM {_ITEMS}",
    "r10_item_names": f"SELECT receipt_id, line_no, item_name, round(total_price, 4) AS total_price FROM {_ITEMS}",
    "r11_quantities": f"SELECT receipt_id, line_no, quantity, round(unit_price, 4) AS unit_price FROM {_ITEMS}",
    "r12_accepted_items": f"SELECT receipt_id, count(*) AS n_items FROM {_ITEMS} GROUP BY receipt_id",
    "r13_item_category": f"SELECT p_partkey, {_category_sql('p_name')} AS category FROM part",
    "r14_parse": f"""SELECT {_K} AS receipt_id, {_STORE} AS store_name, {_ADDRESS} AS store_address,
        {_PARSED_DATE} AS receipt_date, round(CAST({_TOTAL} AS DOUBLE), 4) AS total_amount,
        round(CAST({_K} % 3 + 0.3 AS DOUBLE), 4) AS tax_amount, 0.0::DOUBLE AS discount_amount,
        CAST(CASE WHEN {_K} % 4 = 0 THEN 2 ELSE 3 END AS INTEGER) AS n_items FROM orders""",
    "s09_write_receipts": f"""SELECT receipt_id, line_no, item_name, quantity, round(unit_price, 4) AS unit_price,
        round(total_price, 4) AS total_price, category FROM {_ITEMS}""",
}

# the same loop as for D3, over the receipts of the text
ORACLES["s09_linked_receipts"] = (STORE_LOOP + f"""SELECT t.receipt_id, f.store_id, t.store_name, t.store_address, p.receipt_date,
    p.total_amount, p.tax_amount, 0.0::DOUBLE AS discount_amount, true AS is_processed
    FROM store_receipts_v t JOIN {STORE_LINKS} f USING (receipt_id) JOIN (SELECT {_K} AS receipt_id, {_PARSED_DATE} AS receipt_date,
      round(CAST({_TOTAL} AS DOUBLE), 4) AS total_amount, round(CAST({_K} % 3 + 0.3 AS DOUBLE), 4) AS tax_amount FROM orders) p
    USING (receipt_id)""").replace("store_receipts_v", f"(SELECT {_K} AS receipt_id, {_STORE} AS store_name, {_ADDRESS} AS store_address FROM orders)")

QUERIES = {
    "s09_linked_receipts": s09_linked_receipts,
    "r01_clean_lines": r01_clean_lines,
    "r02_ocr_fix": r02_ocr_fix,
    "r03_best_candidate": r03_best_candidate,
    "r04_store_name": r04_store_name,
    "r05_store_address": r05_store_address,
    "r06_receipt_date": r06_receipt_date,
    "r07_total": r07_total,
    "r08_tax_discount": r08_tax_discount,
    "r09_item_lines": r09_item_lines,
    "r10_item_names": r10_item_names,
    "r11_quantities": r11_quantities,
    "r12_accepted_items": r12_accepted_items,
    "r13_item_category": r13_item_category,
    "r14_parse": r14_parse,
    "s09_write_receipts": s09_write_receipts,
}
