"""Data-quality aggregates (Q1–Q10), computed in one pass over the raw rows.

Every metric is an aggregate expression; ``quality_summary`` puts those of the raw rows in one
``agg`` (partial aggregates per task, one tiny final merge). The valid rows need the
deduplication, which reads the key, position and email columns again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.patterns import EMAIL_PATTERN, PHONE_INTERNATIONAL, PHONE_PATTERN, PHONE_STANDARD
from tessera.operators.clean import parse_date, validated


def _matches(c: Column, pattern: str, case_insensitive: bool = True) -> Column:
    flags = "(?iU)" if case_insensitive else "(?U)"
    return c.rlike(flags + pattern)


def null_counts(df: DataFrame) -> DataFrame:
    """Q1: one row per column (position, column, null_count), via a single aggregate + unpivot."""
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    stacked = ", ".join(f"{i}, '{c}', `{c}`" for i, c in enumerate(df.columns))
    return wide.selectExpr(f"stack({len(df.columns)}, {stacked}) AS (position, column_name, null_count)")


def top_null_columns(df: DataFrame, n: int = 5) -> DataFrame:
    """Q2: the ``n`` columns with most nulls (ties by column position), > 0, with % of rows."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (
        null_counts(df).where(F.col("null_count") > 0)
        .orderBy(F.desc("null_count"), F.asc("position")).limit(n)
        .select("column_name", "null_count",
                F.round(F.col("null_count") * 100.0 / total, 4).alias("null_pct"))
    )


def duplicate_count(key: Column) -> Column:
    """Q3: rows that repeat an earlier key; NULL counts as one key value."""
    return (
        F.count(F.lit(1)) - F.count_distinct(key)
        - F.max(F.when(key.isNull(), 1).otherwise(0))
    ).cast("long")


def invalid_email_count(email: Column) -> Column:
    """Q5: non-null emails that do not match the pattern (case-insensitive)."""
    return F.count_if(email.isNotNull() & ~_matches(email, EMAIL_PATTERN))


def invalid_date_count(date_text: Column) -> Column:
    """Q6: unparsable or missing dates."""
    return F.count_if(parse_date(date_text).isNull())


def invalid_phone_count(phone: Column) -> Column:
    """Q7: non-null phones that do not match the pattern (case-insensitive)."""
    return F.count_if(phone.isNotNull() & ~_matches(phone, PHONE_PATTERN))


def _rate(flag: Column, present: Column) -> Column:
    """Share of ``present`` rows with ``flag``; NULL when no row is present."""
    return F.try_divide(F.count_if(present & flag).cast("double"), F.count_if(present).cast("double"))


def consistency_score(email: Column, phone: Column) -> Column:
    """Q10: mean of (email match rate, max(share '+', share standard)) × 100; parts without
    data are left out, no part at all gives 0."""
    email_part = _rate(_matches(email, EMAIL_PATTERN), email.isNotNull())
    phone_part = F.greatest(
        _rate(phone.rlike("(?U)" + PHONE_INTERNATIONAL), phone.isNotNull()),
        _rate(phone.rlike("(?U)" + PHONE_STANDARD), phone.isNotNull()),
    )
    parts = F.array(email_part, phone_part)
    present = F.filter(parts, lambda x: x.isNotNull())
    mean = F.try_divide(F.aggregate(present, F.lit(0.0), lambda a, x: a + x), F.size(present).cast("double"))
    return F.coalesce(mean * 100.0, F.lit(0.0))


def quality_summary(raw: DataFrame, key="customer_id", order_col="idx") -> DataFrame:
    """Q3–Q10 (and the P7 counts Q9 needs) as one row."""
    n_cols = len(raw.columns)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in raw.columns), F.lit(0))
    k = F.col(key)
    base = raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        duplicate_count(k).alias("duplicate_count"),
        F.count_distinct(k).alias("unique_customers"),
        invalid_email_count(F.col("email")).alias("invalid_emails"),
        invalid_date_count(F.col("subscription_date")).alias("invalid_dates"),
        invalid_phone_count(F.col("phone_1")).alias("invalid_phones"),
        nulls.alias("_nulls"),
        consistency_score(F.col("email"), F.col("phone_1")).alias("consistency_score"),
    )
    valid = validated(raw.select(key, order_col, "email"), key, order_col).agg(
        F.count_if(F.col("error").isNull()).alias("valid_rows"),
        F.count_if(F.col("error").isNotNull()).alias("invalid_rows"),
    )
    counts = valid.select(F.struct("valid_rows", "invalid_rows")).scalar()
    v_rows, i_rows = counts.getField("valid_rows"), counts.getField("invalid_rows")
    cells = F.col("total_rows") * n_cols
    return base.select(
        "total_rows", v_rows.alias("valid_rows"), i_rows.alias("invalid_rows"),
        "duplicate_count", "unique_customers", "invalid_emails", "invalid_dates", "invalid_phones",
        F.round(F.coalesce(F.try_divide((cells - F.col("_nulls")) * 100.0, cells), F.lit(0.0)), 4)
        .alias("completeness_score"),
        F.round(F.coalesce(F.try_divide(v_rows * 100.0, F.col("total_rows")), F.lit(0.0)), 4)
        .alias("validity_score"),
        F.round("consistency_score", 4).alias("consistency_score"),
    )
