"""Derived views over the driver tables (see FIXTURES.md §3).

The driver tables hold no nulls or bad values, so these views inject them by key
arithmetic. They are plain projections and joins: nation/customer are dimensions that
Catalyst broadcasts by size; orders stays a partitioned scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import Tables

# Fixed "now" for every clock-dependent rule in the derived data.
AS_OF = "2001-08-02 00:00:00"


def _s(c: Column) -> Column:
    return c.cast("string")


def customers_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    k = F.col("c_custkey")
    first_order = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    base = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(first_order, F.col("o_custkey") == k, "left")
    )
    seg = F.col("c_mktsegment")
    company = (
        F.when(k % 9 == 0, "Acme Tech Ltd").when(k % 9 == 1, "First Capital Bank")
        .when(k % 9 == 2, "Medical Care Inc").when(k % 9 == 3, "Northern Factory PLC")
        .when(k % 9 == 4, "Harbor Advisory LLC").when(k % 9 == 5, "Smith and Sons")
        .when(k % 9 == 6, "Jones-Brown").when(k % 9 == 7, "Blue Group")
    )
    tail = _s(1000 + k % 9000)
    phone_1 = (
        F.when(k % 19 == 0, F.lit(None).cast("string"))
        .when(k % 4 == 0, F.concat(F.lit("+1-555-"), tail))
        .when(k % 4 == 1, F.concat(F.lit("(555)555-"), tail))
        .when(k % 4 == 2, F.concat(F.lit("555.555."), tail, F.lit("x"), _s(k % 100)))
        .otherwise(F.concat(F.lit("call "), _s(k)))
    )
    email = (
        F.when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 13 == 0, F.concat(F.lower(seg), F.lit(".example.com")))
        .when(k % 11 == 0, F.concat(F.lit("user "), _s(k), F.lit("@bad")))
        .when(k % 5 == 0, F.concat(F.lit("User"), _s(k), F.lit("@Gmail.com")))
        .otherwise(F.concat(F.lit("user"), _s(k), F.lit("@"), F.lower(seg), F.lit(".com")))
    )
    subscription = (
        F.when(k % 31 == 0, "not-a-date").when(k % 37 == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.col("first_order").cast("date")))
    )
    website = (
        F.when(k % 9 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 3, "www.nohost.example/x")
        .otherwise(F.concat(F.lit("https://"), F.lower(seg), F.lit(".example.com/c/"), _s(k)))
    )
    return base.select(
        (k + 1).alias("idx"),
        F.when(k % 97 == 96, F.lit(None).cast("string"))
        .when(k % 50 == 49, F.concat(F.lit("CUST"), _s(k - 1)))
        .otherwise(F.concat(F.lit("CUST"), _s(k))).alias("customer_id"),
        F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")).alias("first_name"),
        seg.alias("last_name"),
        company.alias("company"),
        F.concat(F.lit("City "), _s(k % 20)).alias("city"),
        F.when(k % 40 == 7, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("country"),
        phone_1.alias("phone_1"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("555-"), tail)).alias("phone_2"),
        email.alias("email"),
        subscription.alias("subscription_date"),
        website.alias("website"),
    )


def receipts_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("receipt_id"),
            F.col("c_nationkey").alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("o_orderdate").alias("receipt_date"),
            F.col("o_totalprice").alias("total_amount"),
        )
    )


def items_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("receipt_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("p_partkey").alias("part_id"),
        F.col("p_name").alias("item_name"),
        F.when(F.col("l_partkey") % 23 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_type")).alias("category"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_price"),
    )


def vectors_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    label = F.col("label")
    return t.embeddings.select(
        F.col("vec_id").alias("id"),
        "embedding",
        F.concat(F.lit("item "), _s(F.col("vec_id"))).alias("content"),
        F.when(label == 9, "{}")
        .otherwise(F.concat(F.lit('{"category":"label_'), _s(label), F.lit('"}'))).alias("metadata"),
    )


def receipt_text_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    d = F.col("o_orderdate")
    nl = F.lit("\n")
    store = (
        F.when(k % 6 == 0, "Corner Family Bakery").when(k % 6 == 1, "  Sunny   Mart  ")
        .otherwise(F.concat(F.lit("Book Stationery "), _s(k % 12), F.lit(" SDN BHD")))
    )
    date_line = F.when(k % 8 == 0, F.concat(F.lit("Date: "), _s(d.cast("date")))).otherwise(
        F.concat(
            F.lit("Date: "), F.lpad(_s(F.dayofmonth(d)), 2, "0"), F.lit("/"),
            F.lpad(_s(F.month(d)), 2, "0"), F.lit("/"), _s(F.year(d)),
        )
    )
    total_line = F.when(k % 7 == 0, F.concat(F.lit("TOTAL $l"), _s(k % 10), F.lit(".SO"))).otherwise(
        F.concat(F.lit("TOTAL $"), _s(k % 60 + 10), F.lit(".00"))
    )
    text = F.concat(
        _s(100000 + k), nl, store, nl, nl,
        F.lit("No 12 Jalan Besar"), nl, F.lit("43300 Town"), nl,
        date_line, nl,
        _s(k % 4), F.lit(" x Pilot Pen "), _s(k % 50 + 1), F.lit(".50"), nl,
        F.lit("Fresh Milk 1L   "), _s(k % 9 + 2), F.lit(".20"), nl,
        F.lit("Shampoo (large) $"), _s(k % 7 + 5), F.lit(".00"), nl,
        F.lit("Subtotal "), _s(k % 60 + 9), F.lit(".70"), nl,
        F.lit("GST 6% "), _s(k % 3), F.lit(".30"), nl,
        total_line, nl,
        F.lit("CHANGE 5.00"), nl, F.lit("Thank you"),
    )
    return t.orders.select(k.alias("doc_id"), text.alias("raw_text"))


def questions_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per customer (the whole table, no id subset)."""
    t = Tables(spark, sf_dir)
    k = F.col("c_custkey")
    m = k % 12
    q = (
        F.when(m == 0, "How much have I spent?").when(m == 1, "Where do I shop the most?")
        .when(m == 2, "What items do I buy frequently?").when(m == 3, "Show me my spending summary")
        .when(m == 4, "Compare my spending at different stores").when(m == 5, "total spent last month")
        .when(m == 6, F.concat(F.lit("money spent at "), F.col("n_name")))
        .when(m == 7, "receipts over $1000.50 in the past year")
        .when(m == 8, F.concat(F.lit("spent less than $"), _s(k * 1000)))
        .when(m == 9, "total cost for the past 45 days").when(m == 10, "yesterday")
        .otherwise("hello")
    )
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        k.alias("question_id"), q.alias("question")
    )


def stores_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing store dimension: every supplier, under a longer shop name; odd ones under a name of
    their own, so that their receipts match no existing store."""
    t = Tables(spark, sf_dir)
    k = F.col("s_suppkey")
    kind = (F.when(k % 5 == 0, "Mini Mart").when(k % 5 == 1, "Coffee House").when(k % 5 == 2, "Book Store")
            .when(k % 5 == 3, "Tech Mobile").otherwise("Outlet"))
    cat = (F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 5 == 0, "Grocery").when(k % 5 == 1, "Restaurant")
           .when(k % 5 == 2, "Stationery").when(k % 5 == 3, "Electronics").otherwise("Other"))
    own = F.when(k % 2 == 0, F.col("s_name")).otherwise(F.concat(F.lit("Depot "), _s(k)))
    return t.supplier.select(
        k.alias("id"), F.concat(F.lit("The "), own, F.lit(" "), kind).alias("name"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Lot "), _s(k))).alias("address"),
        cat.alias("category"),
    )


def store_receipts_v(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming receipts: one per order, at the supplier of its lowest supplier key."""
    t = Tables(spark, sf_dir)
    k = F.col("o_orderkey")
    first_supp = t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("sk"))
    suffix = (F.when(k % 4 == 0, " Sdn Bhd").when(k % 4 == 1, " Pte Ltd").when(k % 4 == 2, " INC").otherwise(""))
    # some names lie inside others, some have inner runs of spaces
    name = (F.when(k % 16 == 3, F.concat(F.lit("Big "), F.col("s_name"), F.lit(" East")))
            .when(k % 16 == 7, F.concat(F.lit("Plaza   "), F.col("s_name"))).when(k % 16 == 11, F.concat(F.lit("Plaza "), F.col("s_name")))
            .otherwise(F.concat(F.col("s_name"), suffix)))
    return (
        t.orders.join(first_supp, F.col("l_orderkey") == k)
        .join(t.supplier, F.col("s_suppkey") == F.col("sk"))
        .select(k.alias("receipt_id"), name.alias("store_name"),
                F.when(k % 5 == 0, F.lit(None).cast("string"))
                .otherwise(F.concat(F.lit("No "), _s(k % 100), F.lit(" Jalan Besar"))).alias("store_address"))
    )
