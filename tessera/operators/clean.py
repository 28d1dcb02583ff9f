"""Cleaning, typing and validation of customer-style rows.

Profiling reads the raw rows; only validity counts read the cleaned, deduplicated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.patterns import CHUNK_SIZE, MAX_ERRORS, MAX_ERRORS_PER_CHUNK, NA_TOKENS

TEXT_COLUMNS = ["email", "first_name", "last_name", "company", "city", "country"]
PHONE_COLUMNS = ["phone_1", "phone_2"]


def strip_ws(c) -> Column:
    """Python ``str.strip()``: whitespace of any kind at both ends."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def na_to_null(c) -> Column:
    """A field holding a missing-value token becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def parse_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    """Lenient date parse; an unparsable value gives NULL instead of an error."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def first_per_key(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """Keep the first row of each key (lowest ``order_col``); NULL keys form one group.

    ``order_col`` is the row's position, unique in the table. The lowest position per key is a
    hash aggregate over two columns (a key holding a third of the rows is reduced map-side);
    the rows at those positions are kept by a semi join, which column pruning goes through.
    """
    firsts = df.groupBy(key).agg(F.min(order_col).alias(order_col)).select(order_col)
    return df.join(firsts, order_col, "left_semi")


def clean(df: DataFrame) -> DataFrame:
    """Trimmed text, lower-case email, parsed subscription date, trimmed phones."""
    out = df.withColumns({c: strip_ws(c) for c in TEXT_COLUMNS + PHONE_COLUMNS if c in df.columns})
    if "email" in out.columns:
        out = out.withColumn("email", F.lower("email"))
    if "subscription_date" in out.columns:
        out = out.withColumn("subscription_date", parse_date("subscription_date"))
    return out


def validation_error(id_col="customer_id", email_col="email") -> Column:
    """First failing rule's message, NULL when the row is valid (id checked first).

    NULL id and NULL email are invalid (the reference turns them into the text ``nan``).
    """
    cid, email = F.col(id_col), F.col(email_col)
    return (
        F.when(cid.isNull() | (strip_ws(cid) == ""), F.lit("Customer ID cannot be empty"))
        .when(email.isNull() | ~email.contains("@"),
              F.concat(F.lit("Invalid email format: "), F.coalesce(email, F.lit("None"))))
    )


def validated(raw: DataFrame, key="customer_id", order_col="idx") -> DataFrame:
    """P1 + P2–P6: deduplicated, cleaned rows with an ``error`` column."""
    return clean(first_per_key(raw, key, order_col)).withColumn("error", validation_error())


def processing_counts(raw: DataFrame, key="customer_id", order_col="idx") -> DataFrame:
    """Total raw rows, processed (valid) and failed rows, success rate %."""
    v = validated(raw.select(key, order_col, "email"), key, order_col).agg(
        F.count_if(F.col("error").isNull()).alias("processed_rows"),
        F.count_if(F.col("error").isNotNull()).alias("failed_rows"),
    )
    total = raw.select(F.count(F.lit(1))).scalar()
    return v.select(
        total.alias("total_rows"), "processed_rows", "failed_rows",
        F.round(F.try_divide(F.col("processed_rows") * 100.0, total), 4).alias("success_rate"),
    )


def error_sample(raw: DataFrame, key="customer_id", order_col="idx", chunk_size: int = CHUNK_SIZE,
                 per_chunk: int = MAX_ERRORS_PER_CHUNK, max_errors: int = MAX_ERRORS) -> DataFrame:
    """At most ``per_chunk`` messages per chunk of ``chunk_size`` rows, ``max_errors`` in all.

    Chunks follow the row position ``order_col``; the cap is the feature (a bounded sample).
    """
    errs = validated(raw, key, order_col).where(F.col("error").isNotNull())
    errs = errs.withColumn("chunk", ((F.col(order_col) - 1) / chunk_size).cast("long"))
    w = Window.partitionBy("chunk").orderBy(order_col)
    return (
        errs.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= per_chunk)
        .orderBy("chunk", order_col)
        .limit(max_errors)
        .select("chunk", F.col(order_col).alias("row"),
                F.concat(F.lit("Chunk "), F.col("chunk").cast("string"), F.lit(", Row "),
                         F.col(order_col).cast("string"), F.lit(": "), F.col("error")).alias("message"))
    )


def item_constraints() -> Column:
    """Receipt item record constraints (name 1–255, category ≤ 100, qty > 0, prices ≥ 0)."""
    name, cat = F.col("item_name"), F.col("category")
    return (
        name.isNotNull() & (F.length(name) >= 1) & (F.length(name) <= 255)
        & (cat.isNull() | (F.length(cat) <= 100))
        & (F.col("quantity") > 0)
        & (F.col("unit_price") >= 0) & (F.col("total_price") >= 0)
    )


def split_by_constraints(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = F.coalesce(item_constraints(), F.lit(False))
    return items.where(ok), items.where(~ok)


def receipt_filters(receipts: DataFrame, since=None, store: str | None = None,
                    amount_op: str | None = None, amount: float | None = None) -> DataFrame:
    """P10: optional date ≥, store name contains (case-insensitive), amount > / <."""
    out = receipts
    if since is not None:
        out = out.where(F.col("receipt_date") >= F.lit(since).cast("timestamp_ntz"))
    if store:
        out = out.where(F.lower("store_name").contains(store.lower()))
    if amount_op == "greater":
        out = out.where(F.col("total_amount") > amount)
    elif amount_op == "less":
        out = out.where(F.col("total_amount") < amount)
    return out
