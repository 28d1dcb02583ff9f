"""The whole customer profile as one nested row, for JSON.

The rows are written once as they are. All frequency tables then come from one scan with a grouping set per column
(``frequencies``), all counts over the rows from another; quartiles take the exact ``describe`` of the numeric column. What is
folded into the nested row is bounded: top lists, years, seasons, and a figure per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.patterns import INDUSTRY_SEGMENTS, SEASONS
from tessera.operators import profile as B
from tessera.operators import quality as Q
from tessera.operators.clean import parse_date, strip_ws
from tessera.session import shared_dir

# --- fixed values: how many values each list of the report shows --------------------------
SHOWN = {"countries": 15, "companies": 15, "email_domains": 15, "website_domains": 10, "months": 12}
PENETRATION = 10

_NUMBERS, _TEXTS = "map<string,double>", "map<string,string>"
#: the report's blocks and their parts
LAYOUT = {
    "data_quality": {"scores": _NUMBERS, "missing_values": _NUMBERS},
    "business_insights": {"geographic_distribution": _NUMBERS, "company_distribution": _NUMBERS, "industry_segments": _NUMBERS, "market_penetration": _NUMBERS},
    "communication_analysis": {"email_domains": _NUMBERS, "phone_patterns": _NUMBERS, "website_domains": _NUMBERS,
                               "communication_preferences": _NUMBERS, "contact_completeness": _NUMBERS},
    "temporal_analysis": {"subscription_by_year": _NUMBERS, "subscription_by_month": _NUMBERS, "seasonal_patterns": _NUMBERS, "growth": _NUMBERS,
                          "date_range": _TEXTS, "trend": _TEXTS},
    "columns_info": {"data_types": _TEXTS},
    "statistical_summary": {"numeric_stats": _NUMBERS},
}
SCHEMA = ", ".join(f"{b} struct<{','.join(f'{i}: {t}' for i, t in items.items())}>" for b, items in LAYOUT.items())


def frequencies(df: DataFrame, columns: dict[str, Column], **more: Column) -> DataFrame:
    """(kind, value, count, ...): the value counts of all ``columns`` in one scan, each row expanded to a grouping set per column and
    counted where it is read. Null values have a row of their own per kind. ``more`` are aggregates over a kind's value."""
    rows = df.select(*df.columns, *[c.cast("string").alias(f"_k_{k}") for k, c in columns.items()])
    keys = [f"_k_{k}" for k in columns]
    grouped = rows.groupingSets([[k] for k in keys], *keys).agg(
        F.count(F.lit(1)).alias("count"), *[c.alias(n) for n, c in more.items()], *[F.grouping(k).alias(f"_g{k}") for k in keys])
    kind = F.coalesce(*[F.when(F.col(f"_g_k_{k}") == 0, F.lit(k)) for k in columns])
    return grouped.select(kind.alias("kind"), F.coalesce(*keys).alias("value"), "count", *more)


def _entries(pairs: Column) -> Column:
    """An array of (order, name, value) as a map in that order."""
    return F.map_from_entries(F.transform(F.array_sort(pairs), lambda x: F.struct(x["name"], x["value"])))


def _list(kind: str, order: Column, value: Column | None = None, keep: Column | None = None) -> Column:
    ok = (F.col("kind") == kind) & (keep if keep is not None else F.lit(True))
    v = F.col("count").cast("double") if value is None else value
    return _entries(F.collect_list(F.when(ok, F.struct(order.alias("o"), F.col("value").alias("name"), v.alias("value"))))).alias(kind)


def _figures(names: dict[str, Column]) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[c.cast("double") for c in names.values()]))


def profile_report(customers: DataFrame, key: str = "customer_id", order_col: str = "idx") -> DataFrame:
    """One nested row of ``SCHEMA``. An empty table gives empty lists, zero counts and null shares."""
    spark = customers.sparkSession
    path = shared_dir(spark, "profile")
    customers.write.parquet(path)
    rows = spark.read.schema(customers.schema).parquet(path)
    day = parse_date("subscription_date")
    kinds = {"countries": F.col("country"), "companies": F.col("company"), "email_domains": B.email_domain(F.col("email")),
             "website_domains": B.url_host(F.col("website")), "years": F.year(day), "months": F.date_format(day, "yyyy-MM"),
             "seasons": F.when(day.isNotNull(), B.season_of(F.month(day))), "ids": F.col(key)}
    sound = F.coalesce((strip_ws(key) != "") & F.lower(strip_ws("email")).contains("@"), F.lit(False))
    counts = frequencies(rows, kinds, sound=F.min_by(sound, F.col(order_col)))
    at = shared_dir(spark, "profile-counts")
    counts.write.parquet(at)
    counts = spark.read.schema(counts.schema).parquet(at)

    # first rows of each id: null is an id of its own for the deduplication, not for the distinct count
    ids = counts.where("kind = 'ids'").agg(
        F.struct(F.count("value").alias("unique"), F.count(F.lit(1)).alias("keys"), F.count_if("sound").alias("valid")).alias("s")).select("s").scalar()
    by = Window.partitionBy("kind").orderBy(F.when(F.col("kind") != "months", -F.col("count")), "value")
    limit = F.coalesce(F.create_map(*[F.lit(x) for kv in SHOWN.items() for x in kv])[F.col("kind")], F.lit(1 << 30))
    shown = counts.where("kind <> 'ids' and value is not null").withColumn("rn", F.row_number().over(by)).where(F.col("rn") <= limit)
    total = F.col("_total")
    lists = shown.withColumn("_total", rows.select(F.count(F.lit(1))).scalar()).agg(
        *[_list(k, F.col("rn")) for k in kinds if k not in ("ids", "seasons", "years")], _list("years", F.col("value").cast("long")), _list("seasons", F.col("rn")),
        _list("countries", F.col("rn"), F.round(F.col("count") * 100.0 / total, 4), F.col("rn") <= PENETRATION).alias("penetration"))
    lists = lists.select(F.struct("*").alias("s")).scalar()
    years = counts.where("kind = 'years' and value is not null").select(F.col("value").cast("int").alias("year"), "count")
    growth = B.growth_of(years).select(F.struct("*").alias("s")).scalar()
    stats = B.describe(rows.select(order_col), [order_col]).select(F.struct("count", "mean", "std", "min", "p25", "p50", "p75", "max").alias("s")).scalar()

    present = {"email": F.col("email").isNotNull(), "phone": F.col("phone_1").isNotNull(), "secondary_phone": F.col("phone_2").isNotNull(), "website": F.col("website").isNotNull()}
    e, p, w = present["email"], present["phone"], present["website"]
    phone = F.col("phone_1")
    c = F.col("company")
    n = F.count(F.lit(1))
    flags = rows.agg(
        n.alias("n"), *[F.count_if(F.col(x).isNull()).alias(f"null_{x}") for x in rows.columns],
        Q.invalid_email_count(F.col("email")).alias("invalid_emails"), Q.invalid_date_count(F.col("subscription_date")).alias("invalid_dates"),
        Q.invalid_phone_count(phone).alias("invalid_phones"), Q.consistency_score(F.col("email"), phone).alias("consistency"),
        *[F.count_if(f).alias(f"has_{k}") for k, f in present.items()], F.count_if(e | p | w).alias("has_overall"),
        F.count_if(e & ~p & ~w).alias("email_only"), F.count_if(p & ~e & ~w).alias("phone_only"), F.count_if(e & p).alias("multi_channel"),
        F.count_if(e & p & w).alias("complete_profile"), F.count_if(~e & ~p).alias("minimal_contact"),
        F.count_if(phone.rlike(r"^\+")).alias("international_format"), F.count_if(phone.contains("x")).alias("with_extensions"),
        F.count_if(phone.contains("(")).alias("with_parentheses"),
        *[F.count_if(c.rlike("(?i)" + pattern)).alias(f"seg{i}") for i, (_, pattern) in enumerate(INDUSTRY_SEGMENTS)],
        F.min(day).alias("first"), F.max(day).alias("last"), F.count(day).alias("dated"))
    f = flags.withColumns({"_ids": ids, "_lists": lists, "_growth": growth, "_stats": stats})
    pct = lambda x, of: F.round(F.try_divide(x * 100.0, of), 4)
    cells, missing = F.col("n") * len(rows.columns), sum((F.col(f"null_{x}") for x in rows.columns), F.lit(0))
    unique, keys, valid = F.col("_ids.unique"), F.col("_ids.keys"), F.col("_ids.valid")
    segments = F.map_filter(_figures({name: F.col(f"seg{i}") for i, (name, _) in enumerate(INDUSTRY_SEGMENTS)}), lambda k, v: v > 0)
    seasons = F.map_from_arrays(F.array(*[F.lit(s) for s, _ in SEASONS]), F.array(*[F.coalesce(F.try_element_at(F.col("_lists.seasons"), F.lit(s)), F.lit(0.0)) for s, _ in SEASONS]))
    date_range = {"min_date": F.col("first").cast("string"), "max_date": F.col("last").cast("string"),
                  "total_days": F.datediff("last", "first").cast("string"), "data_points": F.col("dated").cast("string")}
    texts = lambda names: F.map_from_arrays(F.array(*[F.lit(x) for x in names]), F.array(*names.values()))
    blocks = {
        "data_quality": {"scores": _figures({
            "total_rows": F.col("n"), "valid_rows": valid, "invalid_rows": keys - valid, "duplicate_count": F.col("n") - keys, "unique_customers": unique,
            "invalid_emails": F.col("invalid_emails"), "invalid_dates": F.col("invalid_dates"), "invalid_phones": F.col("invalid_phones"),
            "completeness_score": F.coalesce(pct(cells - missing, cells), F.lit(0.0)), "validity_score": F.coalesce(pct(valid, F.col("n")), F.lit(0.0)),
            "consistency_score": F.round("consistency", 4)}),
            "missing_values": _figures({x: F.col(f"null_{x}") for x in rows.columns})},
        "business_insights": {"geographic_distribution": F.col("_lists.countries"), "company_distribution": F.col("_lists.companies"),
                              "industry_segments": segments, "market_penetration": F.col("_lists.penetration")},
        "communication_analysis": {
            "email_domains": F.col("_lists.email_domains"),
            "phone_patterns": _figures({"total_primary_phones": F.col("has_phone"), "total_secondary_phones": F.col("has_secondary_phone"),
                                        **{x: F.col(x) for x in ("international_format", "with_extensions", "with_parentheses")},
                                        "dual_phone_customers": F.col("has_secondary_phone"), "coverage_percentage": pct(F.col("has_phone"), F.col("n"))}),
            "website_domains": F.col("_lists.website_domains"),
            "communication_preferences": _figures({x: F.col(x) for x in ("email_only", "phone_only", "multi_channel", "complete_profile", "minimal_contact")}),
            "contact_completeness": _figures({f"{k}_completeness": pct(F.col(f"has_{k}"), F.col("n")) for k in (*present, "overall")})},
        "temporal_analysis": {"subscription_by_year": F.col("_lists.years"), "subscription_by_month": F.col("_lists.months"), "seasonal_patterns": seasons,
                              "growth": _figures({x: F.col(f"_growth.{x}") for x in ("average_growth_rate", "peak_year", "peak_subscriptions")}),
                              "date_range": texts(date_range), "trend": texts({"trend": F.col("_growth.trend")})},
        "columns_info": {"data_types": texts({x: F.lit(t) for x, t in rows.dtypes})},
        "statistical_summary": {"numeric_stats": _figures({f"{order_col}_{x}": F.col(f"_stats.{x}") for x in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")})},
    }
    return f.select(*[F.struct(*[v.cast(LAYOUT[b][i]).alias(i) for i, v in items.items()]).alias(b) for b, items in blocks.items()])


def report_rows(report: DataFrame) -> DataFrame:
    """A nested report as rows: block, part, name, number, text."""
    out = None
    for b, items in LAYOUT.items():
        for i, kind in items.items():
            number, text = (F.col("value"), F.lit(None).cast("string")) if kind == _NUMBERS else (F.lit(None).cast("double"), F.col("value"))
            part = report.select(F.explode(f"{b}.{i}").alias("name", "value")).select(F.lit(b).alias("block"), F.lit(i).alias("part"), "name", number.alias("number"), text.alias("text"))
            out = part if out is None else out.unionByName(part)
    return out
