"""Registered customer-profile queries (S1, S3, S4, S10, P1–P10, Q1–Q10, B1–B22) and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.patterns import EMAIL_PATTERN, INDUSTRY_SEGMENTS, PHONE_PATTERN
from tessera.operators import clean as P
from tessera.operators import profile as B
from tessera.operators import quality as Q
from tessera.operators import report as R
from tessera.session import shared_dir
from tessera.sources import customers_csv as S
from tessera.sources import views
from tessera.sources.tables import Tables

AS_OF_DATE = "2001-08-02"
CUSTOMER_COLUMNS = ["idx", "customer_id", "first_name", "last_name", "company", "city", "country",
                    "phone_1", "phone_2", "email", "subscription_date", "website"]


def _cust(spark, d):
    return views.customers_v(spark, d)


def _order_dates(spark, d):
    return Tables(spark, d).orders.select(F.col("o_orderdate").cast("date").alias("d"))


# --- sources ---------------------------------------------------------------------------

def _written_csv(spark, d) -> str:
    path = shared_dir(spark, "customers_csv")
    S.write_csv(_cust(spark, d), path)
    return path


def s01_csv_scan(spark, d):
    return S.read_csv(spark, _written_csv(spark, d))


def s10_json_report(spark, d):
    """The whole profile, written as one nested JSON document to the shared folder, read back and laid out in rows."""
    path = S.write_json_report(R.profile_report(_cust(spark, d)), shared_dir(spark, "json_report"))
    rows = R.report_rows(spark.read.schema(R.SCHEMA).json(path))
    return rows.withColumn("number", F.round("number", 4))


# --- cleaning and validation -----------------------------------------------------------

def p01_dedup_first(spark, d):
    return P.first_per_key(_cust(spark, d), "customer_id", "idx").select("customer_id", "idx", "email")


def p01_dedup_orders(spark, d):
    o = Tables(spark, d).orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return P.first_per_key(o, "o_custkey", "o_orderkey")


def p02_trim(spark, d):
    c = _cust(spark, d)
    return c.select("idx", *[P.strip_ws(x).alias(x) for x in ["first_name", "last_name", "company", "city", "country"]])


def p03_lower_email(spark, d):
    return _cust(spark, d).select("idx", F.lower(P.strip_ws("email")).alias("email"))


def p04_parse_date(spark, d):
    return _cust(spark, d).select("idx", P.parse_date("subscription_date").alias("subscription_date"))


def p05_typed_projection(spark, d):
    return P.clean(P.first_per_key(_cust(spark, d), "customer_id", "idx")).select(*CUSTOMER_COLUMNS)


def p06_validate(spark, d):
    return P.validated(_cust(spark, d)).select("idx", "customer_id", "error")


def p07_success_rate(spark, d):
    return P.processing_counts(_cust(spark, d))


def p08_error_sample(spark, d):
    return P.error_sample(_cust(spark, d))


def p09_record_constraints(spark, d):
    items = views.items_v(spark, d)
    ok, bad = P.split_by_constraints(items)
    cols = ["receipt_id", "line_no", "part_id"]
    return ok.select(*cols, F.lit(True).alias("accepted")).unionByName(
        bad.select(*cols, F.lit(False).alias("accepted")))


def p10_receipt_filters(spark, d):
    r = P.receipt_filters(views.receipts_v(spark, d), since="2000-08-02 00:00:00", store="nation_1",
                          amount_op="greater", amount=1000.0)
    return r.select("receipt_id", "store_name", F.col("receipt_date").cast("date").alias("receipt_date"),
                    "total_amount")


# --- quality ---------------------------------------------------------------------------

def q01_null_counts(spark, d):
    return Q.null_counts(_cust(spark, d))


def q02_top_null_columns(spark, d):
    return Q.top_null_columns(_cust(spark, d))


def _quality(*cols):
    def run(spark, d):
        return Q.quality_summary(_cust(spark, d)).select(*cols)
    return run


# --- business profile ------------------------------------------------------------------

def b01_top_countries(spark, d):
    return B.value_counts(_cust(spark, d), "country", 15)


def b02_top_companies(spark, d):
    return B.value_counts(_cust(spark, d), "company", 15)


def b03_market_penetration(spark, d):
    return B.top_with_share(_cust(spark, d), "country", 10)


def b04_top_countries_ranked(spark, d):
    return B.top_with_share(_cust(spark, d), "country", 5)


def b05_industry_segments(spark, d):
    return B.industry_segments(_cust(spark, d))


def b06_date_range(spark, d):
    return B.date_range(_order_dates(spark, d), "d")


def b07_peak_month(spark, d):
    return B.peak_month(_order_dates(spark, d), "d")


def b08_by_year(spark, d):
    return B.by_year(_order_dates(spark, d), "d")


def b09_by_month(spark, d):
    return B.by_month_of_year(_order_dates(spark, d), "d")


def b10_first_months(spark, d):
    return B.first_months(_order_dates(spark, d), "d")


def b11_busiest_months(spark, d):
    return B.busiest_months(_order_dates(spark, d), "d")


def b12_by_season(spark, d):
    return B.by_season(_order_dates(spark, d), "d")


def b13_growth(spark, d):
    return B.growth_metrics(_order_dates(spark, d), "d")


def b14_peak_year(spark, d):
    return B.growth_metrics(_order_dates(spark, d), "d").select("peak_year", "peak_subscriptions")


def b13_growth_customers(spark, d):
    c = _cust(spark, d).select(P.parse_date("subscription_date").alias("d"))
    return B.growth_metrics(c, "d")


def b15_email_domains(spark, d):
    return B.email_domains(_cust(spark, d)).select("domain", "count")


def b16_domain_labels(spark, d):
    return B.email_domains(_cust(spark, d))


def b17_phone_patterns(spark, d):
    return B.phone_patterns(_cust(spark, d))


def b18_website_summary(spark, d):
    return B.website_summary(_cust(spark, d), "website")


def b18_top_hosts(spark, d):
    return B.top_hosts(Tables(spark, d).pages, "url")


def b19_channel_preferences(spark, d):
    return B.communication_preferences(_cust(spark, d))


def b20_contact_completeness(spark, d):
    return B.contact_completeness(_cust(spark, d))


def _rounded_describe(df):
    return df.select("column_name", "count", *[F.round(c, 4).alias(c) for c in
                                               ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def b21_describe_lineitem(spark, d):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return _rounded_describe(B.describe(Tables(spark, d).lineitem, cols))


def b21_describe_customer(spark, d):
    return _rounded_describe(B.describe(Tables(spark, d).customer, ["c_acctbal"]))


# --- oracles ---------------------------------------------------------------------------

def _ws_strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


_DEDUP = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY idx) AS _rn
    FROM customers_v) WHERE _rn = 1)"""
_VALIDATED = f"""(SELECT idx, customer_id, CASE
      WHEN customer_id IS NULL OR {_ws_strip('customer_id')} = '' THEN 'Customer ID cannot be empty'
      WHEN e IS NULL OR NOT contains(e, '@') THEN 'Invalid email format: ' || coalesce(e, 'None') END AS error
    FROM (SELECT *, lower({_ws_strip('email')}) AS e FROM {_DEDUP}))"""
_NULLS = " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count(*) - count({c}) AS null_count FROM customers_v"
    for i, c in enumerate(CUSTOMER_COLUMNS))
_NULL_SUM = " + ".join(f"(count(*) - count({c}))" for c in CUSTOMER_COLUMNS)
_EMAIL_OK = f"regexp_matches(email, '{EMAIL_PATTERN}', 'i')"
_PHONE_OK = f"regexp_matches(phone_1, '{PHONE_PATTERN}', 'i')"
_QUALITY = f"""(SELECT count(*) AS total_rows,
    (SELECT count(*) FILTER (WHERE error IS NULL) FROM {_VALIDATED}) AS valid_rows,
    (SELECT count(*) FILTER (WHERE error IS NOT NULL) FROM {_VALIDATED}) AS invalid_rows,
    CAST(count(*) - count(DISTINCT customer_id) - max(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
      AS duplicate_count,
    count(DISTINCT customer_id) AS unique_customers,
    count(*) FILTER (WHERE email IS NOT NULL AND NOT {_EMAIL_OK}) AS invalid_emails,
    count(*) FILTER (WHERE try_strptime(subscription_date, '%Y-%m-%d') IS NULL) AS invalid_dates,
    count(*) FILTER (WHERE phone_1 IS NOT NULL AND NOT {_PHONE_OK}) AS invalid_phones,
    {_NULL_SUM} AS nulls,
    avg(CASE WHEN {_EMAIL_OK} THEN 1.0 ELSE 0.0 END) FILTER (WHERE email IS NOT NULL) AS e_rate,
    greatest(avg(CASE WHEN regexp_matches(phone_1, '^\\+') THEN 1.0 ELSE 0.0 END) FILTER (WHERE phone_1 IS NOT NULL),
             avg(CASE WHEN regexp_matches(phone_1, '^[\\d\\-\\s\\(\\)\\.]+$') THEN 1.0 ELSE 0.0 END)
               FILTER (WHERE phone_1 IS NOT NULL)) AS p_rate
  FROM customers_v)"""
_QUALITY_ROW = f"""SELECT total_rows, valid_rows, invalid_rows, duplicate_count, unique_customers,
    invalid_emails, invalid_dates, invalid_phones,
    round((total_rows * {len(CUSTOMER_COLUMNS)} - nulls) * 100.0 / (total_rows * {len(CUSTOMER_COLUMNS)}), 4)::DOUBLE
      AS completeness_score,
    round(valid_rows * 100.0 / total_rows, 4)::DOUBLE AS validity_score,
    round(CASE WHEN e_rate IS NULL AND p_rate IS NULL THEN 0.0 WHEN e_rate IS NULL THEN p_rate * 100.0
               WHEN p_rate IS NULL THEN e_rate * 100.0 ELSE (e_rate + p_rate) / 2 * 100.0 END, 4)::DOUBLE
      AS consistency_score
  FROM {_QUALITY}"""
_DATES = "(SELECT CAST(o_orderdate AS DATE) AS d FROM orders)"
_YEARS = f"(SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS count FROM {_DATES} GROUP BY 1)"


def _growth(years: str) -> str:
    return f"""SELECT CASE WHEN n < 2 THEN 0.0 ELSE round(coalesce(g, 0.0), 2) END::DOUBLE AS average_growth_rate,
      CASE WHEN n < 2 THEN 'insufficient_data' WHEN coalesce(g, 0.0) > 5 THEN 'growing'
           WHEN coalesce(g, 0.0) < -5 THEN 'declining' ELSE 'stable' END AS trend,
      peak_year, peak_subscriptions
    FROM (SELECT count(*) AS n, avg(growth) AS g, arg_max(year, count * 100000 - year) AS peak_year,
            max(count) AS peak_subscriptions
          FROM (SELECT year, count, CASE WHEN lag(count) OVER (ORDER BY year) > 0 THEN
                  (count - lag(count) OVER (ORDER BY year)) * 100.0 / lag(count) OVER (ORDER BY year) END AS growth
                FROM {years}))"""


def _top(expr: str, name: str, src: str, n: int) -> str:
    return f"""SELECT {expr} AS {name}, count(*) AS count FROM {src} WHERE {expr} IS NOT NULL
        GROUP BY 1 ORDER BY count DESC, {name} LIMIT {n}"""


def _share(n: int) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY count DESC, value) AS INTEGER) AS rank, value, count,
        round(count * 100.0 / (SELECT count(*) FROM customers_v), 4)::DOUBLE AS share_pct
        FROM ({_top('country', 'value', 'customers_v', n)})"""


_DOMAIN = "lower(email).split('@')[2]"
_HOST = "nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\\-]*://([^/?#]*)', 1), '')"


def _describe(table: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean,
            round(stddev_samp({c}), 4) AS std, round(min({c}), 4)::DOUBLE AS min,
            round(quantile_cont({c}, 0.25), 4) AS p25, round(quantile_cont({c}, 0.5), 4) AS p50,
            round(quantile_cont({c}, 0.75), 4) AS p75, round(max({c}), 4)::DOUBLE AS max FROM {table}""")
    return " UNION ALL ".join(parts)


_SEGMENTS = " UNION ALL ".join(
    f"SELECT '{name}' AS segment, count(*) FILTER (WHERE regexp_matches(company, '{pat}', 'i')) AS count FROM customers_v"
    for name, pat in INDUSTRY_SEGMENTS)

_CDATES = "(SELECT CAST(try_strptime(subscription_date, '%Y-%m-%d') AS DATE) AS d FROM customers_v)"
_CYEARS = f"(SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS count FROM {_CDATES} WHERE d IS NOT NULL GROUP BY 1)"
_TYPES = {c: "string" for c in CUSTOMER_COLUMNS} | {"idx": "bigint"}


def _part(block: str, part: str, name: str, number: str, src: str, text: str = "NULL") -> str:
    return f"SELECT '{block}' AS block, '{part}' AS part, CAST({name} AS VARCHAR) AS name, CAST({number} AS DOUBLE) AS number, CAST({text} AS VARCHAR) AS text FROM {src}"


def _row(block: str, part: str, columns: list[str], src: str) -> str:
    return " UNION ALL ".join(_part(block, part, f"'{c}'", c, src) for c in columns)


def _report_sql() -> str:
    o = ORACLES
    seasons = o["b12_by_season"].replace(_DATES, f"(SELECT d FROM {_CDATES} WHERE d IS NOT NULL)")
    growth = f"({_growth(_CYEARS)})"
    dates = f"(SELECT min(d) AS a, max(d) AS b, count(d) AS n FROM {_CDATES})"
    stats = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    q, b, c, t = "data_quality", "business_insights", "communication_analysis", "temporal_analysis"
    parts = [
        _row(q, "scores", ["total_rows", "valid_rows", "invalid_rows", "duplicate_count", "unique_customers", "invalid_emails", "invalid_dates",
                           "invalid_phones", "completeness_score", "validity_score", "consistency_score"], f"({_QUALITY_ROW})"),
        _part(q, "missing_values", "column_name", "null_count", f"({_NULLS})"),
        _part(b, "geographic_distribution", "value", "count", f"({o['b01_top_countries']})"),
        _part(b, "company_distribution", "value", "count", f"({o['b02_top_companies']})"),
        _part(b, "industry_segments", "segment", "count", f"({o['b05_industry_segments']})"),
        _part(b, "market_penetration", "value", "share_pct", f"({o['b03_market_penetration']})"),
        _part(c, "email_domains", "domain", "count", f"({o['b15_email_domains']})"),
        _row(c, "phone_patterns", ["total_primary_phones", "total_secondary_phones", "international_format", "with_extensions", "with_parentheses",
                                   "dual_phone_customers", "coverage_percentage"], f"({o['b17_phone_patterns']})"),
        _part(c, "website_domains", "host", "count", f"({_top(_HOST.replace('url', 'website'), 'host', 'customers_v', 10)})"),
        _row(c, "communication_preferences", ["email_only", "phone_only", "multi_channel", "complete_profile", "minimal_contact"], f"({o['b19_channel_preferences']})"),
        _row(c, "contact_completeness", ["email_completeness", "phone_completeness", "secondary_phone_completeness", "website_completeness",
                                         "overall_completeness"], f"({o['b20_contact_completeness']})"),
        _part(t, "subscription_by_year", "year", "count", _CYEARS),
        _part(t, "subscription_by_month", "month", "count", f"(SELECT strftime(d, '%Y-%m') AS month, count(*) AS count FROM {_CDATES} WHERE d IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 12)"),
        _part(t, "seasonal_patterns", "season", "count", f"({seasons})"),
        _row(t, "growth", ["average_growth_rate", "peak_year", "peak_subscriptions"], growth),
        *[_part(t, "date_range", f"'{n}'", "NULL", dates, x) for n, x in {"min_date": "a", "max_date": "b", "total_days": "datediff('day', a, b)", "data_points": "n"}.items()],
        _part(t, "trend", "'trend'", "NULL", growth, "trend"),
        *[f"SELECT 'columns_info', 'data_types', '{x}', NULL, '{kind}'" for x, kind in _TYPES.items()],
        *[_part("statistical_summary", "numeric_stats", f"'idx_{x}'", x, f"({_describe('customers_v', ['idx'])})") for x in stats],
    ]
    return " UNION ALL ".join(f"({p})" if "LIMIT" in p else p for p in parts)


ORACLES = {
    "s01_csv_scan": "SELECT * FROM customers_v",
    "p01_dedup_first": f"SELECT customer_id, idx, email FROM {_DEDUP}",
    "p01_dedup_orders": """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER
        (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1""",
    "p02_trim": "SELECT idx, " + ", ".join(f"{_ws_strip(c)} AS {c}" for c in
                                          ["first_name", "last_name", "company", "city", "country"]) + " FROM customers_v",
    "p03_lower_email": f"SELECT idx, lower({_ws_strip('email')}) AS email FROM customers_v",
    "p04_parse_date": """SELECT idx, CAST(try_strptime(subscription_date, '%Y-%m-%d') AS DATE) AS subscription_date
        FROM customers_v""",
    "p05_typed_projection": f"""SELECT idx, customer_id, {_ws_strip('first_name')} AS first_name,
        {_ws_strip('last_name')} AS last_name, {_ws_strip('company')} AS company, {_ws_strip('city')} AS city,
        {_ws_strip('country')} AS country, {_ws_strip('phone_1')} AS phone_1, {_ws_strip('phone_2')} AS phone_2,
        lower({_ws_strip('email')}) AS email,
        CAST(try_strptime(subscription_date, '%Y-%m-%d') AS DATE) AS subscription_date, website FROM {_DEDUP}""",
    "p06_validate": f"SELECT idx, customer_id, error FROM {_VALIDATED}",
    "p07_success_rate": f"""SELECT (SELECT count(*) FROM customers_v) AS total_rows,
        count(*) FILTER (WHERE error IS NULL) AS processed_rows, count(*) FILTER (WHERE error IS NOT NULL) AS failed_rows,
        round(count(*) FILTER (WHERE error IS NULL) * 100.0 / (SELECT count(*) FROM customers_v), 4)::DOUBLE
          AS success_rate FROM {_VALIDATED}""",
    "p08_error_sample": f"""SELECT chunk, row, 'Chunk ' || CAST(chunk AS VARCHAR) || ', Row ' || CAST(row AS VARCHAR)
        || ': ' || error AS message FROM (
          SELECT CAST((idx - 1) // 8192 AS BIGINT) AS chunk, idx AS row, error,
                 row_number() OVER (PARTITION BY (idx - 1) // 8192 ORDER BY idx) AS rn
          FROM {_VALIDATED} WHERE error IS NOT NULL) WHERE rn <= 5 ORDER BY chunk, row LIMIT 50""",
    "p09_record_constraints": """SELECT receipt_id, line_no, part_id, coalesce(item_name IS NOT NULL
        AND length(item_name) BETWEEN 1 AND 255 AND (category IS NULL OR length(category) <= 100)
        AND quantity > 0 AND unit_price >= 0 AND total_price >= 0, false) AS accepted FROM items_v""",
    "p10_receipt_filters": """SELECT receipt_id, store_name, CAST(receipt_date AS DATE) AS receipt_date, total_amount
        FROM receipts_v WHERE receipt_date >= TIMESTAMP '2000-08-02 00:00:00'
        AND contains(lower(store_name), 'nation_1') AND total_amount > 1000.0""",
    "q01_null_counts": _NULLS,
    "q02_top_null_columns": f"""SELECT column_name, null_count,
        round(null_count * 100.0 / (SELECT count(*) FROM customers_v), 4)::DOUBLE AS null_pct
        FROM ({_NULLS}) WHERE null_count > 0 ORDER BY null_count DESC, position LIMIT 5""",
    "q03_duplicates": f"SELECT duplicate_count FROM ({_QUALITY_ROW})",
    "q04_unique_customers": f"SELECT unique_customers FROM ({_QUALITY_ROW})",
    "q05_invalid_emails": f"SELECT invalid_emails FROM ({_QUALITY_ROW})",
    "q06_invalid_dates": f"SELECT invalid_dates FROM ({_QUALITY_ROW})",
    "q07_invalid_phones": f"SELECT invalid_phones FROM ({_QUALITY_ROW})",
    "q08_completeness": f"SELECT completeness_score FROM ({_QUALITY_ROW})",
    "q09_validity": f"SELECT valid_rows, validity_score FROM ({_QUALITY_ROW})",
    "q10_consistency": f"SELECT consistency_score FROM ({_QUALITY_ROW})",
    "q00_quality_summary": _QUALITY_ROW,
    "b01_top_countries": _top("country", "value", "customers_v", 15),
    "b02_top_companies": _top("company", "value", "customers_v", 15),
    "b03_market_penetration": _share(10),
    "b04_top_countries_ranked": _share(5),
    "b05_industry_segments": f"SELECT * FROM ({_SEGMENTS}) WHERE count > 0",
    "b06_date_range": f"""SELECT count(*) AS data_points, min(d) AS min_date, max(d) AS max_date,
        CAST(datediff('day', min(d), max(d)) AS INTEGER) AS total_days FROM {_DATES}""",
    "b07_peak_month": _top("strftime(d, '%Y-%m')", "month", _DATES, 1),
    "b08_by_year": f"SELECT * FROM {_YEARS}",
    "b09_by_month": f"SELECT CAST(month(d) AS INTEGER) AS month, count(*) AS count FROM {_DATES} GROUP BY 1",
    "b10_first_months": f"""SELECT strftime(d, '%Y-%m') AS month, count(*) AS count FROM {_DATES}
        GROUP BY 1 ORDER BY 1 LIMIT 12""",
    "b11_busiest_months": _top("strftime(d, '%Y-%m')", "month", _DATES, 12),
    "b12_by_season": f"""SELECT s.season_order, s.season, coalesce(c.count, 0) AS count FROM
        (VALUES (0, 'Spring'), (1, 'Summer'), (2, 'Fall'), (3, 'Winter')) s(season_order, season)
        LEFT JOIN (SELECT CASE WHEN month(d) IN (3, 4, 5) THEN 'Spring' WHEN month(d) IN (6, 7, 8) THEN 'Summer'
                   WHEN month(d) IN (9, 10, 11) THEN 'Fall' ELSE 'Winter' END AS season, count(*) AS count
                   FROM {_DATES} GROUP BY 1) c ON s.season = c.season""",
    "b13_growth": _growth(_YEARS),
    "b14_peak_year": f"SELECT peak_year, peak_subscriptions FROM ({_growth(_YEARS)})",
    "b13_growth_customers": _growth(
        "(SELECT CAST(year(d) AS INTEGER) AS year, count(*) AS count FROM (SELECT CAST(try_strptime("
        "subscription_date, '%Y-%m-%d') AS DATE) AS d FROM customers_v) WHERE d IS NOT NULL GROUP BY 1)"),
    "b15_email_domains": _top(_DOMAIN, "domain", "customers_v", 15),
    "b16_domain_labels": f"""SELECT domain, CASE WHEN domain IN ('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com')
        THEN 'Personal - ' ELSE 'Corporate - ' END || domain AS label, count
        FROM ({_top(_DOMAIN, 'domain', 'customers_v', 15)})""",
    "b17_phone_patterns": """SELECT count(phone_1) AS total_primary_phones, count(phone_2) AS total_secondary_phones,
        count(*) FILTER (WHERE regexp_matches(phone_1, '^\\+')) AS international_format,
        count(*) FILTER (WHERE contains(phone_1, 'x')) AS with_extensions,
        count(*) FILTER (WHERE contains(phone_1, '(')) AS with_parentheses,
        count(phone_2) AS dual_phone_customers,
        round(count(phone_1) * 100.0 / count(*), 4)::DOUBLE AS coverage_percentage FROM customers_v""",
    "b18_website_summary": f"""SELECT count(website) AS total_websites,
        count(DISTINCT {_HOST.replace('url', 'website')}) AS unique_domains,
        round(count(website) * 100.0 / count(*), 4)::DOUBLE AS website_coverage FROM customers_v""",
    "b18_top_hosts": _top(_HOST, "host", "pages", 10),
    "b19_channel_preferences": """SELECT
        count(*) FILTER (WHERE email IS NOT NULL AND phone_1 IS NULL AND website IS NULL) AS email_only,
        count(*) FILTER (WHERE phone_1 IS NOT NULL AND email IS NULL AND website IS NULL) AS phone_only,
        count(*) FILTER (WHERE email IS NOT NULL AND phone_1 IS NOT NULL) AS multi_channel,
        count(*) FILTER (WHERE email IS NOT NULL AND phone_1 IS NOT NULL AND website IS NOT NULL) AS complete_profile,
        count(*) FILTER (WHERE email IS NULL AND phone_1 IS NULL) AS minimal_contact FROM customers_v""",
    "b20_contact_completeness": """SELECT
        round(count(email) * 100.0 / count(*), 4)::DOUBLE AS email_completeness,
        round(count(phone_1) * 100.0 / count(*), 4)::DOUBLE AS phone_completeness,
        round(count(phone_2) * 100.0 / count(*), 4)::DOUBLE AS secondary_phone_completeness,
        round(count(website) * 100.0 / count(*), 4)::DOUBLE AS website_completeness,
        round(count(*) FILTER (WHERE email IS NOT NULL OR phone_1 IS NOT NULL OR website IS NOT NULL) * 100.0
              / count(*), 4)::DOUBLE AS overall_completeness FROM customers_v""",
    "b21_describe_lineitem": _describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]),
    "b21_describe_customer": _describe("customer", ["c_acctbal"]),
}

ORACLES["s10_json_report"] = _report_sql()

QUERIES = {
    "s01_csv_scan": s01_csv_scan,
    "s10_json_report": s10_json_report,
    "p01_dedup_first": p01_dedup_first,
    "p01_dedup_orders": p01_dedup_orders,
    "p02_trim": p02_trim,
    "p03_lower_email": p03_lower_email,
    "p04_parse_date": p04_parse_date,
    "p05_typed_projection": p05_typed_projection,
    "p06_validate": p06_validate,
    "p07_success_rate": p07_success_rate,
    "p08_error_sample": p08_error_sample,
    "p09_record_constraints": p09_record_constraints,
    "p10_receipt_filters": p10_receipt_filters,
    "q00_quality_summary": _quality("total_rows", "valid_rows", "invalid_rows", "duplicate_count",
                                    "unique_customers", "invalid_emails", "invalid_dates", "invalid_phones",
                                    "completeness_score", "validity_score", "consistency_score"),
    "q01_null_counts": q01_null_counts,
    "q02_top_null_columns": q02_top_null_columns,
    "q03_duplicates": _quality("duplicate_count"),
    "q04_unique_customers": _quality("unique_customers"),
    "q05_invalid_emails": _quality("invalid_emails"),
    "q06_invalid_dates": _quality("invalid_dates"),
    "q07_invalid_phones": _quality("invalid_phones"),
    "q08_completeness": _quality("completeness_score"),
    "q09_validity": _quality("valid_rows", "validity_score"),
    "q10_consistency": _quality("consistency_score"),
    "b01_top_countries": b01_top_countries,
    "b02_top_companies": b02_top_companies,
    "b03_market_penetration": b03_market_penetration,
    "b04_top_countries_ranked": b04_top_countries_ranked,
    "b05_industry_segments": b05_industry_segments,
    "b06_date_range": b06_date_range,
    "b07_peak_month": b07_peak_month,
    "b08_by_year": b08_by_year,
    "b09_by_month": b09_by_month,
    "b10_first_months": b10_first_months,
    "b11_busiest_months": b11_busiest_months,
    "b12_by_season": b12_by_season,
    "b13_growth": b13_growth,
    "b13_growth_customers": b13_growth_customers,
    "b14_peak_year": b14_peak_year,
    "b15_email_domains": b15_email_domains,
    "b16_domain_labels": b16_domain_labels,
    "b17_phone_patterns": b17_phone_patterns,
    "b18_website_summary": b18_website_summary,
    "b18_top_hosts": b18_top_hosts,
    "b19_channel_preferences": b19_channel_preferences,
    "b20_contact_completeness": b20_contact_completeness,
    "b21_describe_lineitem": b21_describe_lineitem,
    "b21_describe_customer": b21_describe_customer,
}
