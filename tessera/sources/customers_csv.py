"""Customer CSV source and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.clean import na_to_null

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("idx", T.LongType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("company", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("phone_1", T.StringType()),
    T.StructField("phone_2", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("subscription_date", T.StringType()),
    T.StructField("website", T.StringType()),
])

_CSV_OPTIONS = {
    "header": "true",
    # keep surrounding spaces: trimming is a cleaning step (P2), not the reader's job
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "PERMISSIVE",
}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**_CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = CUSTOMER_SCHEMA) -> DataFrame:
    """Declared schema (no inference pass), header, missing-value tokens → NULL."""
    raw = spark.read.schema(schema).options(**_CSV_OPTIONS).csv(path)
    return raw.select(*[
        na_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in schema.fields
    ])


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """S3: header names only; Spark reads the first line, no data pass."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path).columns


def schema_report(df: DataFrame) -> DataFrame:
    """Column count, names and types as rows (metadata; no job)."""
    rows = [(i, name, dtype) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def to_json_report(df: DataFrame, name: str = "report") -> DataFrame:
    """Each row of a summary as one nested JSON document."""
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias(name))


def write_json_report(df: DataFrame, path: str) -> str:
    """S10 sink: one JSON document per row (nested structs stay nested)."""
    df.write.mode("overwrite").json(path)
    return path
