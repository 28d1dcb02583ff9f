
import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.functions import receipt_text as RT
from tessera.functions.vector_fns import cosine, normalize
from tessera.operators import profile as B
from tessera.operators import questions as N
from tessera.operators import stores as D

AS_OF = "2001-08-02 00:00:00"


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).collect()[0]["out"]


@pytest.mark.parametrize("text,expected", [
    ("Date: 15/01/2024", dt.datetime(2024, 1, 15)),
    ("2024-01-15", dt.datetime(2015, 1, 24)),          # quirk: yy-mm-dd read as dd-mm-yy
    ("no date here", dt.datetime(2001, 8, 2)),          # falls back to as_of
    ("on 31-12-99 ok", dt.datetime(1999, 12, 31)),      # two-digit year pivot
])
def test_receipt_date(spark, text, expected):
    lines = RT.clean_lines(F.col("x"))
    assert _one(spark, RT.receipt_date(lines, AS_OF), text) == expected


def _items(spark, text):
    return _one(spark, RT.items(RT.clean_lines(F.col("x"))), text)


def test_item_with_quantity(spark):
    (it,) = _items(spark, "2 x PEN 5.00")
    assert (it["item_name"], it["quantity"], it["unit_price"], it["total_price"], it["category"]) == \
        ("PEN", 2.0, 2.5, 5.0, "Stationery")


def test_item_plain(spark):
    (it,) = _items(spark, "MILK 1L 3.50")
    assert (it["item_name"], it["quantity"], it["category"]) == ("MILK 1L", 1.0, "Dairy")


def test_change_line_is_not_an_item(spark):
    assert _items(spark, "CHANGE 5.00") == []


def test_zero_quantity_rejected(spark):
    assert _items(spark, "0 x Pilot Pen 2.50") == []


def test_category_substring_quirk(spark):
    assert _one(spark, RT.item_category(F.col("x")), "Shampoo") == "Meat & Seafood"


def test_ocr_repair(spark):
    assert _one(spark, RT.ocr_fix(F.col("x")), "TOTAL $l2.SO") == "TOTAL $12.50"


def test_total_and_tax(spark):
    text = "Shop Mart\nSubtotal 9.70\nGST 6% 0.30\nTOTAL $l2.SO"
    lines = RT.clean_lines(F.col("x"))
    assert _one(spark, RT.total_amount(lines), text) == 12.5
    assert _one(spark, RT.tax_amount(lines), text) == 0.3


def test_store_name_and_address(spark):
    text = "100123\nBook Stationery 3 SDN BHD\nNo 12 Jalan Besar\n43300 Town\nDate: 01/02/2000"
    lines = RT.clean_lines(F.col("x"))
    assert _one(spark, RT.store_name(lines), text) == "Book Stationery 3 SDN BHD"
    assert _one(spark, RT.store_address(lines), text) == "No 12 Jalan Besar, 43300 Town, Date: 01/02/2000"
    assert _one(spark, RT.store_name(lines), "12\nab") == "Unknown Store"


@pytest.mark.parametrize("q,intent", [
    ("How much have I spent?", "SPENDING"),
    ("Where do I shop the most?", "STORE"),
    ("What items do I buy frequently?", "ITEM"),
    ("Show me my spending summary", "SUMMARY"),
    ("Compare my spending at different stores", "STORE"),
    ("hello", "FALLBACK"),
])
def test_intent(spark, q, intent):
    assert _one(spark, N.intent(F.col("x")), q) == intent


def test_question_filters(spark):
    assert _one(spark, N.time_filter(F.col("x"), AS_OF), "past 10 days") == dt.datetime(2001, 7, 23)
    assert _one(spark, N.time_filter(F.col("x"), AS_OF), "today") == dt.datetime(2001, 8, 2)
    a = _one(spark, N.amount_filter(F.col("x")), "receipts over $50")
    assert (a["operator"], a["value"]) == ("greater", 50.0)
    assert _one(spark, N.store_filter(F.col("x")), "money spent at NATION_3") == "NATION"
    assert _one(spark, N.store_filter(F.col("x")), "What items do I buy frequently?") == "items do I buy frequently"
    assert _one(spark, N.store_filter(F.col("x")), "receipts over $5 in the past year") == "the past year"


def test_cosine_zero_and_length(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert df.select(cosine("a", "b")).collect()[0][0] == 0.0
    bad = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0, 0.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception):
        bad.select(cosine("a", "b")).collect()
    assert bad.select(cosine("a", "b", strict=False)).collect()[0][0] is None
    z = spark.createDataFrame([([0.0, 0.0],)], "a array<double>")
    assert z.select(normalize("a")).collect()[0][0] == [0.0, 0.0]


def test_store_normalize(spark):
    assert _one(spark, D.normalize_name(F.col("x")), "Acme Pte Ltd") == "acme pte"
    assert _one(spark, D.normalize_name(F.col("x")), "  ACME   Sdn Bhd ") == "acme"
    assert _one(spark, D.store_category(F.col("x")), "Mini Mart Express") == "Grocery"


def test_email_domain(spark):
    assert _one(spark, B.email_domain(F.col("x")), "abc") is None
    assert _one(spark, B.email_domain(F.col("x")), "A@Gmail.COM") == "gmail.com"


def test_url_host(spark):
    host = B.url_host(F.col("x"))
    assert _one(spark, host, "https://a.example/x") == "a.example"
    assert _one(spark, host, "http://u@h.example:80/") == "u@h.example:80"
    assert _one(spark, host, "www.a.example") is None
    assert _one(spark, host, "http://bad host") is None
