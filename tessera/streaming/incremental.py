"""Incremental (streaming) profiling with Structured Streaming.

The reference accumulates order-insensitive counters chunk by chunk. Here the chunks are
micro-batches of a file stream (``maxFilesPerTrigger`` bounds each one), the counters are
streaming aggregates whose state lives in the checkpointed state store, and results land
in Parquet under the shared folder. ``trigger(availableNow=True)`` processes what exists
and stops, so the same code serves a backfill and a scheduled incremental run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.operators.clean import first_per_key, parse_date
from tessera.operators.profile import email_domain, season_of, url_host
from tessera.operators.report import PENETRATION, SHOWN
from tessera.session import shared_dir


def event_stream(spark: SparkSession, folder: str, file_name: str = "events.parquet",
                 max_files_per_trigger: int = 1) -> DataFrame:
    """A file stream over ``folder`` in bounded batches (declared schema, no inference)."""
    schema = spark.read.parquet(f"{folder.rstrip('/')}/{file_name}").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_name)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder))


def file_stream(spark: SparkSession, folder: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """A file stream over Parquet files that arrive in ``folder``."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_to_table(stream: DataFrame, out_path: str, mode: str = "complete", name: str = "stream", checkpoint: str | None = None) -> str:
    """Run a streaming query to completion. Every micro-batch writes under its ``batch_id``, so a replayed batch is idempotent:
    its own rows (append), or a whole version of the result (complete), of which ``latest`` reads the last. A
    version that readers see isn't written again while later ones come.
    With a ``checkpoint`` folder of its own a later run goes on where this one ended."""
    spark = stream.sparkSession
    ckpt = checkpoint or shared_dir(spark, f"stream-ckpt-{name}")

    def sink(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _run(q)
    return out_path


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last version of a complete result."""
    versions = spark.read.parquet(path)
    return versions.where(F.col("batch_id") == versions.select(F.max("batch_id")).scalar()).drop("batch_id")


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Running value counts of ``key`` (nulls skipped)."""
    return stream.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def customer_counters(customers: DataFrame) -> DataFrame:
    """(counter, value) pairs of the accumulated report: countries, companies, e-mail domains, years,
    months, seasons and website hosts; what is missing gives no pair."""
    day = parse_date("subscription_date")
    values = {
        "countries": F.col("country"), "companies": F.col("company"), "email_domains": email_domain(F.col("email")),
        "years": F.year(day).cast("string"), "months": F.date_format(day, "yyyy-MM"),
        "seasons": F.when(day.isNotNull(), season_of(F.month(day))), "website_domains": url_host(F.col("website")),
    }
    pairs = F.array(*[F.struct(F.lit(k).alias("counter"), v.alias("value")) for k, v in values.items()])
    return customers.select(F.inline(pairs)).where(F.col("value").isNotNull())


def running_nulls(stream: DataFrame, phone_col: str | None = None) -> DataFrame:
    """Running row count and null count per column, and with ``phone_col`` the pattern flags of the
    phones (all, international, with extension), as one global aggregate."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in stream.columns]
    if phone_col:
        p = F.col(phone_col)
        aggs += [F.count(p).alias("phones_total"), F.count_if(p.rlike(r"^\+")).alias("phones_international"),
                 F.count_if(p.contains("x")).alias("phones_extensions")]
    return stream.agg(*aggs)


def running_distinct(stream: DataFrame, key: str, exact: bool = True) -> DataFrame:
    """Running distinct keys. Exact: streaming ``dropDuplicates`` (state grows with the
    number of keys) then a count; otherwise ``approx_count_distinct`` (bounded state)."""
    if exact:
        return stream.select(key).where(F.col(key).isNotNull()).dropDuplicates([key]).agg(
            F.count(F.lit(1)).alias("distinct_keys"))
    return stream.agg(F.approx_count_distinct(key).alias("distinct_keys"))


def per_batch_validation(stream: DataFrame, out_path: str, key: str, order_col: str,
                         valid: "F.Column", name: str = "validate") -> str:
    """T4: inside each micro-batch, keep the first row per key, validate, and write that
    batch's counts under its ``batch_id`` (overwrite → idempotent on replay)."""
    spark = stream.sparkSession
    ckpt = shared_dir(spark, f"stream-ckpt-{name}")

    def sink(df: DataFrame, batch_id: int) -> None:
        firsts = first_per_key(df, key, order_col)
        rows_in = df.select(F.count(F.lit(1))).scalar()
        counts = firsts.agg(F.count_if(valid).alias("processed"), F.count_if(~valid).alias("failed")).select(
            rows_in.alias("rows_in"), "processed", "failed")
        counts.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
            f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    _run(q)
    return out_path


def totals_from_batches(spark: SparkSession, path: str) -> DataFrame:
    """T4: running totals = sum of the per-batch counts."""
    return spark.read.parquet(path).agg(
        F.sum("rows_in").alias("rows_in"), F.sum("processed").alias("processed"), F.sum("failed").alias("failed"),
        F.count_distinct("batch_id").alias("batches"))


def top_from_state(counts: DataFrame, key: str, n: int) -> DataFrame:
    """T5: top ``n`` of an accumulated counter (count desc, key asc)."""
    return counts.orderBy(F.desc("count"), F.asc(key)).limit(n)


def accumulated_report(counts: DataFrame, flags: DataFrame, distinct: DataFrame, batches: DataFrame, schema: StructType) -> DataFrame:
    """T5: the report over the accumulated state, one row a figure: (section, name, value).

    ``counts``: (counter, value, count) of T1; ``flags``: the row of T2; ``distinct``: the row of T3; ``batches``: the row of T4's
    totals; ``schema``: of the rows. The most frequent values of each counter (``SHOWN``), all years and seasons (ties by
    value); the share of the most frequent countries in all rows; phone patterns; the quality figures; the columns
    by position with their types in the names; the summary.
    """
    shown, n_columns = SHOWN, len(schema)
    w = Window.partitionBy("counter").orderBy(F.desc("count"), F.asc("value"))
    limit = F.coalesce(F.create_map(*[F.lit(x) for kv in shown.items() for x in kv])[F.col("counter")], F.lit(1 << 30))
    top = counts.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= limit).select(
        F.col("counter").alias("section"), F.col("value").alias("name"), F.col("count").cast("double").alias("value"))
    f = flags.withColumn("distinct_keys", distinct.select("distinct_keys").scalar())
    missing = sum((F.col(c) for c in flags.columns if c.startswith("null_")), F.lit(0))
    cells = F.col("total_rows") * n_columns
    figures = {("quality", "total_rows"): F.col("total_rows"), ("quality", "missing_values"): missing,
               ("quality", "duplicate_count"): F.col("total_rows") - F.col("distinct_keys"),
               ("quality", "unique_customers"): F.col("distinct_keys"),
               ("quality", "completeness_score"): F.round(F.try_divide((cells - missing) * 100.0, cells), 4)}
    figures |= {("summary", "total_records"): F.col("total_rows"), ("summary", "chunks_processed"): batches.select("batches").scalar(),
                ("summary", "unique_customers"): F.col("distinct_keys"), ("columns", "total_columns"): F.lit(n_columns)}
    figures |= {("columns", f"{c.name}: {c.dataType.simpleString()}"): F.lit(i) for i, c in enumerate(schema)}
    figures |= {("phone_patterns", c[7:]): F.col(c) for c in flags.columns if c.startswith("phones_")}
    figures |= {("missing_values", c[5:]): F.col(c) for c in flags.columns if c.startswith("null_")}
    rows = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), v.cast("double").alias("value")) for (s, n), v in figures.items()])
    # the countries shown are more than those whose share is
    by_share = counts.where("counter = 'countries'").orderBy(F.desc("count"), "value").limit(PENETRATION)
    share = by_share.select(F.lit("market_penetration").alias("section"), F.col("value").alias("name"),
                            F.round(F.try_divide(F.col("count") * 100.0, flags.select("total_rows").scalar()), 4).alias("value"))
    return top.unionByName(share).unionByName(f.select(F.inline(rows)))


def differs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one result and not the other, both ways (empty when equal)."""
    return a.exceptAll(b).unionByName(b.exceptAll(a))
