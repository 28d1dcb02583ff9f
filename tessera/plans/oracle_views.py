"""SQL text of the derived views, used as CTEs in the DuckDB oracles.

Same rows as ``tessera.sources.views`` (checked by tests/test_views.py).
"""

CUSTOMERS_V = """
SELECT c_custkey + 1 AS idx,
  CASE WHEN c_custkey % 97 = 96 THEN NULL WHEN c_custkey % 50 = 49 THEN 'CUST' || CAST(c_custkey - 1 AS VARCHAR)
       ELSE 'CUST' || CAST(c_custkey AS VARCHAR) END AS customer_id,
  ' ' || c_name || ' ' AS first_name, c_mktsegment AS last_name,
  CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN 'Acme Tech Ltd' WHEN 1 THEN 'First Capital Bank' WHEN 2 THEN 'Medical Care Inc'
       WHEN 3 THEN 'Northern Factory PLC' WHEN 4 THEN 'Harbor Advisory LLC' WHEN 5 THEN 'Smith and Sons'
       WHEN 6 THEN 'Jones-Brown' WHEN 7 THEN 'Blue Group' ELSE NULL END AS company,
  'City ' || CAST(c_custkey % 20 AS VARCHAR) AS city,
  CASE WHEN c_custkey % 40 = 7 THEN NULL ELSE n_name END AS country,
  CASE WHEN c_custkey % 19 = 0 THEN NULL
       WHEN c_custkey % 4 = 0 THEN '+1-555-' || CAST(1000 + c_custkey % 9000 AS VARCHAR)
       WHEN c_custkey % 4 = 1 THEN '(555)555-' || CAST(1000 + c_custkey % 9000 AS VARCHAR)
       WHEN c_custkey % 4 = 2 THEN '555.555.' || CAST(1000 + c_custkey % 9000 AS VARCHAR) || 'x' || CAST(c_custkey % 100 AS VARCHAR)
       ELSE 'call ' || CAST(c_custkey AS VARCHAR) END AS phone_1,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE '555-' || CAST(1000 + c_custkey % 9000 AS VARCHAR) END AS phone_2,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       WHEN c_custkey % 13 = 0 THEN lower(c_mktsegment) || '.example.com'
       WHEN c_custkey % 11 = 0 THEN 'user ' || CAST(c_custkey AS VARCHAR) || '@bad'
       WHEN c_custkey % 5 = 0 THEN 'User' || CAST(c_custkey AS VARCHAR) || '@Gmail.com'
       ELSE 'user' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.com' END AS email,
  CASE WHEN c_custkey % 31 = 0 THEN 'not-a-date' WHEN c_custkey % 37 = 0 THEN NULL
       ELSE CAST(CAST(first_order AS DATE) AS VARCHAR) END AS subscription_date,
  CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 10 = 3 THEN 'www.nohost.example/x'
       ELSE 'https://' || lower(c_mktsegment) || '.example.com/c/' || CAST(c_custkey AS VARCHAR) END AS website
FROM customer JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f ON o_custkey = c_custkey
"""

RECEIPTS_V = """
SELECT o_orderkey AS receipt_id, c_nationkey AS store_id, n_name AS store_name, o_orderdate AS receipt_date,
  o_totalprice AS total_amount
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

ITEMS_V = """
SELECT l_orderkey AS receipt_id, l_linenumber AS line_no, p_partkey AS part_id, p_name AS item_name,
  CASE WHEN l_partkey % 23 = 0 THEN NULL ELSE p_type END AS category, l_quantity AS quantity,
  l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

VECTORS_V = """
SELECT vec_id AS id, embedding, 'item ' || CAST(vec_id AS VARCHAR) AS content,
  CASE WHEN label = 9 THEN '{}' ELSE '{"category":"label_' || CAST(label AS VARCHAR) || '"}' END AS metadata
FROM embeddings
"""

RECEIPT_TEXT_V = """
SELECT o_orderkey AS doc_id,
  CAST(100000 + o_orderkey AS VARCHAR) || chr(10) ||
  CASE WHEN o_orderkey % 6 = 0 THEN 'Corner Family Bakery' WHEN o_orderkey % 6 = 1 THEN '  Sunny   Mart  '
       ELSE 'Book Stationery ' || CAST(o_orderkey % 12 AS VARCHAR) || ' SDN BHD' END || chr(10) || chr(10) ||
  'No 12 Jalan Besar' || chr(10) || '43300 Town' || chr(10) ||
  CASE WHEN o_orderkey % 8 = 0 THEN 'Date: ' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
       ELSE 'Date: ' || lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
            || '/' || CAST(year(o_orderdate) AS VARCHAR) END || chr(10) ||
  CAST(o_orderkey % 4 AS VARCHAR) || ' x Pilot Pen ' || CAST(o_orderkey % 50 + 1 AS VARCHAR) || '.50' || chr(10) ||
  'Fresh Milk 1L   ' || CAST(o_orderkey % 9 + 2 AS VARCHAR) || '.20' || chr(10) ||
  'Shampoo (large) $' || CAST(o_orderkey % 7 + 5 AS VARCHAR) || '.00' || chr(10) ||
  'Subtotal ' || CAST(o_orderkey % 60 + 9 AS VARCHAR) || '.70' || chr(10) ||
  'GST 6% ' || CAST(o_orderkey % 3 AS VARCHAR) || '.30' || chr(10) ||
  CASE WHEN o_orderkey % 7 = 0 THEN 'TOTAL $l' || CAST(o_orderkey % 10 AS VARCHAR) || '.SO'
       ELSE 'TOTAL $' || CAST(o_orderkey % 60 + 10 AS VARCHAR) || '.00' END || chr(10) ||
  'CHANGE 5.00' || chr(10) || 'Thank you' AS raw_text
FROM orders
"""

QUESTIONS_V = """
SELECT c_custkey AS question_id,
  CASE CAST(c_custkey % 12 AS INT) WHEN 0 THEN 'How much have I spent?' WHEN 1 THEN 'Where do I shop the most?'
    WHEN 2 THEN 'What items do I buy frequently?' WHEN 3 THEN 'Show me my spending summary'
    WHEN 4 THEN 'Compare my spending at different stores' WHEN 5 THEN 'total spent last month'
    WHEN 6 THEN 'money spent at ' || n_name WHEN 7 THEN 'receipts over $1000.50 in the past year'
    WHEN 8 THEN 'spent less than $' || CAST(c_custkey * 1000 AS VARCHAR) WHEN 9 THEN 'total cost for the past 45 days'
    WHEN 10 THEN 'yesterday' ELSE 'hello' END AS question
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""

STORES_V = """
SELECT s_suppkey AS id, 'The ' || CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'Depot ' || CAST(s_suppkey AS VARCHAR) END || ' ' || CASE s_suppkey % 5 WHEN 0 THEN 'Mini Mart' WHEN 1 THEN 'Coffee House'
    WHEN 2 THEN 'Book Store' WHEN 3 THEN 'Tech Mobile' ELSE 'Outlet' END AS name,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'Lot ' || CAST(s_suppkey AS VARCHAR) END AS address,
  CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'Grocery' WHEN s_suppkey % 5 = 1 THEN 'Restaurant'
    WHEN s_suppkey % 5 = 2 THEN 'Stationery' WHEN s_suppkey % 5 = 3 THEN 'Electronics' ELSE 'Other' END AS category
FROM supplier
"""

STORE_RECEIPTS_V = """
SELECT o_orderkey AS receipt_id,
  CASE o_orderkey % 16 WHEN 3 THEN 'Big ' || s_name || ' East' WHEN 7 THEN 'Plaza   ' || s_name WHEN 11 THEN 'Plaza ' || s_name
    ELSE s_name || CASE o_orderkey % 4 WHEN 0 THEN ' Sdn Bhd' WHEN 1 THEN ' Pte Ltd' WHEN 2 THEN ' INC' ELSE '' END END AS store_name,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'No ' || CAST(o_orderkey % 100 AS VARCHAR) || ' Jalan Besar' END
    AS store_address
FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey) f ON l_orderkey = o_orderkey
JOIN supplier ON s_suppkey = sk
"""

VIEWS = {
    "customers_v": CUSTOMERS_V,
    "receipts_v": RECEIPTS_V,
    "items_v": ITEMS_V,
    "vectors_v": VECTORS_V,
    "receipt_text_v": RECEIPT_TEXT_V,
    "questions_v": QUESTIONS_V,
    "store_receipts_v": STORE_RECEIPTS_V,
    "stores_v": STORES_V,
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the views it names."""
    used = [name for name in VIEWS if name in sql]
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in used)
    body = sql.lstrip()
    if body[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{body[14:]}"
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:]}"
    return f"WITH {ctes}\n{body}"
