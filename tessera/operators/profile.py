"""Frequencies, contact-channel, calendar and numeric profiles.

Top-N lists are ``groupBy().count()`` followed by ``orderBy(count desc, key asc).limit(n)``,
which Spark plans as a partial aggregate and a ``TakeOrderedAndProject`` (no global sort).
Windows without ``partitionBy`` appear only over already-aggregated rows (years, months).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.patterns import INDUSTRY_SEGMENTS, PERSONAL_EMAIL_DOMAINS, SEASONS

QUARTILES = (0.25, 0.5, 0.75)
BRACKET_ACCURACY = 10_000


def _total(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def value_counts(df: DataFrame, key, n: int | None = None, name: str = "value") -> DataFrame:
    """Non-null value counts, most frequent first (ties by value); top ``n`` when given."""
    k = F.col(key) if isinstance(key, str) else key
    counts = df.where(k.isNotNull()).groupBy(k.alias(name)).agg(F.count(F.lit(1)).alias("count"))
    ordered = counts.orderBy(F.desc("count"), F.asc(name))
    return ordered.limit(n) if n is not None else ordered


def top_with_share(df: DataFrame, key: str, n: int) -> DataFrame:
    """Top ``n`` values with rank and share of **all** rows × 100."""
    total = _total(df)
    top = value_counts(df, key, n)
    w = Window.orderBy(F.desc("count"), F.asc("value"))  # over at most n rows
    return top.select(
        F.row_number().over(w).alias("rank"), "value", "count",
        F.round(F.col("count") * 100.0 / total, 4).alias("share_pct"),
    )


def industry_segments(df: DataFrame, company_col="company") -> DataFrame:
    """Overlapping case-insensitive segment matches; zero counts dropped."""
    c = F.col(company_col)
    wide = df.agg(*[F.count_if(c.isNotNull() & c.rlike("(?i)" + p)).alias(f"s{i}")
                    for i, (_, p) in enumerate(INDUSTRY_SEGMENTS)])
    stacked = ", ".join(f"'{name}', s{i}" for i, (name, _) in enumerate(INDUSTRY_SEGMENTS))
    return wide.selectExpr(f"stack({len(INDUSTRY_SEGMENTS)}, {stacked}) AS (segment, count)").where("count > 0")


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """Count, first, last and span in days of the valid dates."""
    d = F.col(date_col)
    return df.where(d.isNotNull()).agg(
        F.count(F.lit(1)).alias("data_points"), F.min(d).alias("min_date"), F.max(d).alias("max_date"),
    ).select("data_points", "min_date", "max_date",
             F.datediff("max_date", "min_date").alias("total_days"))


def _month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def peak_month(df: DataFrame, date_col: str) -> DataFrame:
    """The busiest ``yyyy-MM`` (earliest on a tie)."""
    return value_counts(df, _month(F.col(date_col)), 1, "month")


def by_year(df: DataFrame, date_col: str) -> DataFrame:
    """Count per year, ascending."""
    d = F.col(date_col)
    return (df.where(d.isNotNull()).groupBy(F.year(d).alias("year"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("year"))


def by_month_of_year(df: DataFrame, date_col: str) -> DataFrame:
    """Count per month number 1–12."""
    d = F.col(date_col)
    return (df.where(d.isNotNull()).groupBy(F.month(d).alias("month"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("month"))


def first_months(df: DataFrame, date_col: str, n: int = 12) -> DataFrame:
    """The ``n`` oldest calendar months with their counts."""
    d = F.col(date_col)
    return (df.where(d.isNotNull()).groupBy(_month(d).alias("month"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("month").limit(n))


def busiest_months(df: DataFrame, date_col: str, n: int = 12) -> DataFrame:
    """The ``n`` busiest calendar months (ties: older first)."""
    return value_counts(df, _month(F.col(date_col)), n, "month")


def season_of(month: Column) -> Column:
    expr = None
    for name, months in SEASONS:
        expr = (F.when(month.isin(months), name) if expr is None else expr.when(month.isin(months), name))
    return expr


def by_season(df: DataFrame, date_col: str) -> DataFrame:
    """All four seasons, zero when absent (left join from the fixed season list)."""
    spark = df.sparkSession
    names = spark.createDataFrame([(i, n) for i, (n, _) in enumerate(SEASONS)], "season_order int, season string")
    d = F.col(date_col)
    counts = (df.where(d.isNotNull()).groupBy(season_of(F.month(d)).alias("season"))
              .agg(F.count(F.lit(1)).alias("count")))
    return (F.broadcast(names).join(counts, "season", "left")
            .select("season_order", "season", F.coalesce("count", F.lit(0)).cast("long").alias("count")))


def growth_metrics(df: DataFrame, date_col: str) -> DataFrame:
    """Mean year-over-year % over present years, trend, peak year (earliest on tie).

    Fewer than two years → growth 0.0 and ``insufficient_data`` (peak still reported).
    """
    return growth_of(by_year(df, date_col))


def growth_of(years: DataFrame) -> DataFrame:
    """B13/B14 from the counts per year (year, count)."""
    w = Window.orderBy("year")  # one row per year
    yoy = years.withColumn("prev", F.lag("count").over(w)).withColumn(
        "growth", F.when(F.col("prev") > 0, (F.col("count") - F.col("prev")) * 100.0 / F.col("prev"))
    )
    agg = yoy.agg(
        F.count(F.lit(1)).alias("n_years"),
        F.avg("growth").alias("avg_growth"),
        F.max_by("year", F.struct(F.col("count"), -F.col("year"))).alias("peak_year"),
        F.max("count").alias("peak_subscriptions"),
    )
    # the trend is judged on the mean itself; only the output is rounded
    mean = F.when(F.col("n_years") < 2, F.lit(0.0)).otherwise(F.coalesce("avg_growth", F.lit(0.0)))
    trend = (F.when(F.col("n_years") < 2, "insufficient_data")
             .when(mean > 5, "growing").when(mean < -5, "declining").otherwise("stable"))
    return agg.select(F.round(mean, 2).alias("average_growth_rate"), trend.alias("trend"),
                      "peak_year", "peak_subscriptions")


def email_domain(email: Column) -> Column:
    """Second piece of the lower-cased email split on ``@`` (NULL when absent)."""
    return F.get(F.split(F.lower(email), "@"), 1)


def email_domains(df: DataFrame, email_col="email", n: int = 15) -> DataFrame:
    """Top domains labelled Personal or Corporate."""
    top = value_counts(df, email_domain(F.col(email_col)), n, "domain")
    label = F.when(F.col("domain").isin(PERSONAL_EMAIL_DOMAINS), F.lit("Personal - ")).otherwise(F.lit("Corporate - "))
    return top.select("domain", F.concat(label, F.col("domain")).alias("label"), "count")


def phone_patterns(df: DataFrame, p1="phone_1", p2="phone_2") -> DataFrame:
    """All seven phone figures."""
    a, b = F.col(p1), F.col(p2)
    return df.agg(
        F.count(a).alias("total_primary_phones"),
        F.count(b).alias("total_secondary_phones"),
        F.count_if(a.rlike(r"^\+")).alias("international_format"),
        F.count_if(a.contains("x")).alias("with_extensions"),
        F.count_if(a.contains("(")).alias("with_parentheses"),
        F.count(b).alias("dual_phone_customers"),
        F.round(F.try_divide(F.count(a) * 100.0, F.count(F.lit(1))), 4).alias("coverage_percentage"),
    )


def url_host(url: Column) -> Column:
    """The URL's authority (``netloc``); NULL for a bad URL or one without a host."""
    auth = F.try_parse_url(url, F.lit("AUTHORITY"))
    return F.when(auth != "", auth)


def website_summary(df: DataFrame, url_col: str) -> DataFrame:
    """Websites present, distinct hosts, coverage %."""
    u = F.col(url_col)
    return df.agg(
        F.count(u).alias("total_websites"),
        F.count_distinct(url_host(u)).alias("unique_domains"),
        F.round(F.try_divide(F.count(u) * 100.0, F.count(F.lit(1))), 4).alias("website_coverage"),
    )


def top_hosts(df: DataFrame, url_col: str, n: int = 10) -> DataFrame:
    return value_counts(df, url_host(F.col(url_col)), n, "host")


def communication_preferences(df: DataFrame) -> DataFrame:
    """B19."""
    e, p, w = F.col("email").isNotNull(), F.col("phone_1").isNotNull(), F.col("website").isNotNull()
    return df.agg(
        F.count_if(e & ~p & ~w).alias("email_only"),
        F.count_if(p & ~e & ~w).alias("phone_only"),
        F.count_if(e & p).alias("multi_channel"),
        F.count_if(e & p & w).alias("complete_profile"),
        F.count_if(~e & ~p).alias("minimal_contact"),
    )


def contact_completeness(df: DataFrame) -> DataFrame:
    """% of rows with each channel, and with any of email/phone/website."""
    def pct(flag: Column) -> Column:
        return F.round(F.try_divide(F.count_if(flag) * 100.0, F.count(F.lit(1))), 4)

    e, p, w = F.col("email").isNotNull(), F.col("phone_1").isNotNull(), F.col("website").isNotNull()
    return df.agg(
        pct(e).alias("email_completeness"), pct(p).alias("phone_completeness"),
        pct(F.col("phone_2").isNotNull()).alias("secondary_phone_completeness"),
        pct(w).alias("website_completeness"), pct(e | p | w).alias("overall_completeness"),
    )


def describe(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles (linear interpolation), max per column.

    ``exact``: quartiles by rank, from a sketch's brackets and a second scan that keeps about
    4 / BRACKET_ACCURACY of the values; nothing else is shuffled. ``exact=False`` uses
    ``percentile_approx`` alone.
    """
    stacked = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in columns)
    long = df.selectExpr(f"stack({len(columns)}, {stacked}) AS (column_name, value)").where("value IS NOT NULL")
    stats = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
    )
    if not exact:
        q = long.groupBy("column_name").agg(
            F.percentile_approx("value", [0.25, 0.5, 0.75], 100000).alias("q"))
        quart = q.select("column_name", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"),
                         F.col("q")[2].alias("p75"))
        return stats.join(quart, "column_name")
    # exact quartiles in two scans: a sketch gives each quartile a bracket of values (its rank error is
    # 1 / accuracy, the bracket twice as wide); the second scan counts what lies below the bracket and
    # keeps only the values inside it and the nearest ones outside. Rows of the bracket table: the columns given.
    width = 2.0 / BRACKET_ACCURACY
    probs = [x for p in QUARTILES for x in (p - width, p + width)]
    marks = long.groupBy("column_name").agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("value", probs, BRACKET_ACCURACY).alias("_m"))
    cases = F.array(*[F.struct(F.lit(p).alias("p"), F.col("_m")[2 * i].alias("lo"), F.col("_m")[2 * i + 1].alias("hi"))
                      for i, p in enumerate(QUARTILES)])
    held = long.join(F.broadcast(marks.select("column_name", "_n", cases.alias("_cases"))), "column_name").select(
        "column_name", "value", "_n", F.inline("_cases"))
    v = F.col("value")
    around = held.groupBy("column_name", "p", "_n").agg(
        F.count_if(v < F.col("lo")).alias("_below"), F.count_if((v >= F.col("lo")) & (v <= F.col("hi"))).alias("_in"),
        F.max(F.when(v < F.col("lo"), v)).alias("_prev"), F.min(F.when(v > F.col("hi"), v)).alias("_next"))
    inside = held.where((v >= F.col("lo")) & (v <= F.col("hi"))).groupBy("column_name", "p", "value").agg(F.count(F.lit(1)).alias("_cnt"))
    run = inside.withColumn("_b", F.sum("_cnt").over(Window.partitionBy("column_name", "p").orderBy("value")) - F.col("_cnt"))
    pos = run.join(F.broadcast(around), ["column_name", "p"])  # a row a column and quartile
    h = (F.col("_n") - 1) * F.col("p")

    def at(rank: Column) -> Column:
        r = rank - F.col("_below")
        found = F.max(F.when((F.col("_b") <= r) & (r < F.col("_b") + F.col("_cnt")), F.col("value")))
        return F.when(F.first(r) < 0, F.first("_prev")).when(F.first(r) >= F.first("_in"), F.first("_next")).otherwise(found)

    low, high = at(F.floor(h)), at(F.ceil(h))
    each = pos.groupBy("column_name", "p").agg((low + (high - low) * (F.first(h) - F.floor(F.first(h)))).alias("q"))
    quart = each.groupBy("column_name").agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for n, p in zip(("p25", "p50", "p75"), QUARTILES)])
    return stats.join(quart, "column_name")


def columns_by_kind(df: DataFrame) -> DataFrame:
    """Column names grouped as numeric / text / datetime (from the schema, no job)."""
    rows = []
    for i, f in enumerate(df.schema.fields):
        t = f.dataType
        if isinstance(t, T.NumericType):
            kind = "numeric"
        elif isinstance(t, (T.StringType,)):
            kind = "text"
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind = "datetime"
        else:
            kind = "other"
        rows.append((i, f.name, kind))
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, kind string")
