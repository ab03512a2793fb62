"""File sources and sinks: raw CSV, JSON and parquet entities, JSON reports.

Raw CSVs are read with a fixed schema (no inference pass over 100 TB),
``multi_line`` where quoted newlines (multi-line addresses) stay in one record,
and either FAILFAST, so malformed input stops the load instead of turning into
NULLs, or with a quarantine for the lines that do not fit (``load_entity_csv``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY_SCHEMAS: dict[str, T.StructType] = {
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType()), T.StructField("full_name", T.StringType()),
        T.StructField("email", T.StringType()), T.StructField("phone", T.StringType()),
        T.StructField("address", T.StringType()), T.StructField("device_id", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()), T.StructField("ingestion_date", T.DateType())]),
    "accounts": T.StructType([
        T.StructField("account_id", T.StringType()), T.StructField("customer_id", T.StringType()),
        T.StructField("account_type", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("opened_at", T.DateType()), T.StructField("closed_at", T.DateType()),
        T.StructField("ingestion_date", T.DateType())]),
    "transactions": T.StructType([
        T.StructField("transaction_id", T.StringType()), T.StructField("account_id", T.StringType()),
        T.StructField("customer_id", T.StringType()), T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("currency", T.StringType()), T.StructField("merchant_name", T.StringType()),
        T.StructField("status", T.StringType()), T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("settled_at", T.TimestampNTZType()), T.StructField("ingestion_date", T.DateType()),
        T.StructField("card_last_four", T.StringType()), T.StructField("device_id", T.StringType())]),
    "payments": T.StructType([
        T.StructField("payment_id", T.StringType()), T.StructField("transaction_id", T.StringType()),
        T.StructField("payment_method", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("attempt_number", T.IntegerType()), T.StructField("attempted_at", T.TimestampNTZType()),
        T.StructField("ingestion_date", T.DateType())]),
    "subscriptions": T.StructType([
        T.StructField("subscription_id", T.StringType()), T.StructField("customer_id", T.StringType()),
        T.StructField("plan_name", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("start_date", T.DateType()), T.StructField("end_date", T.DateType()),
        T.StructField("ingestion_date", T.DateType())]),
    "refunds": T.StructType([
        T.StructField("refund_id", T.StringType()), T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.DecimalType(18, 2)), T.StructField("refund_reason", T.StringType()),
        T.StructField("refunded_at", T.DateType()), T.StructField("ingestion_date", T.DateType())]),
}

# Spaces around values are kept, also by the writer.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}


def read_entity_csv(spark: SparkSession, path: str, entity: str, multi_line: bool = False) -> DataFrame:
    """Entity rows of CSV files.  With ``multi_line`` quoted values may hold
    line ends, and a file is one task; otherwise files are split."""
    return (spark.read.schema(ENTITY_SCHEMAS[entity]).options(**CSV_OPTIONS).option("multiLine", multi_line)
            .option("mode", "FAILFAST").csv(path))


BAD_LINE = "_bad_line"


class TooManyBadRows(ValueError):
    """A load whose share of lines that do not fit the schema is above what it allows."""


def load_entity_csv(spark: SparkSession, path: str | list[str], entity: str, staging: str, max_bad_share: float = 0.05,
                    header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of CSV files, parsed once into ``staging``.

    A line with a value of another type or with too few or too many values is set aside whole, as
    (entity, line, source_file), in a partition of its own; all others are rows.  Above
    ``max_bad_share`` of all lines the load fails, with the staging table written."""
    fields = ENTITY_SCHEMAS[entity]
    lines = (spark.read.options(**CSV_OPTIONS).option("header", header).option("mode", "PERMISSIVE")
             .schema(T.StructType([*fields, T.StructField(BAD_LINE, T.StringType())]))
             .option("columnNameOfCorruptRecord", BAD_LINE).csv(path))
    seen = Observation()
    (lines.withColumns({"source_file": F.col("_metadata.file_path"), "is_bad": F.col(BAD_LINE).isNotNull()})
     .observe(seen, F.count(F.lit(1)).alias("lines"), F.count(BAD_LINE).alias("bad"))
     .write.mode("overwrite").partitionBy("is_bad").parquet(staging))
    counts = seen.get
    if counts["bad"] > max_bad_share * counts["lines"]:
        raise TooManyBadRows(f"{counts['bad']} of {counts['lines']} lines of {path} do not fit {entity}; see {staging}")
    schema = T.StructType([*fields, T.StructField(BAD_LINE, T.StringType()), T.StructField("source_file", T.StringType()),
                           T.StructField("is_bad", T.BooleanType())])
    staged = spark.read.schema(schema).parquet(staging)
    return (staged.where("not is_bad").select(*fields.names),
            staged.where("is_bad").select(F.lit(entity).alias("entity"), F.col(BAD_LINE).alias("line"), "source_file"))


def read_entity(spark: SparkSession, path: str, entity: str, fmt: str = "csv", multi_line: bool = False) -> DataFrame:
    """A raw entity from CSV, JSON lines or parquet, always with the fixed
    schema (no inference pass; parquet columns are selected and cast)."""
    schema = ENTITY_SCHEMAS[entity]
    if fmt == "csv":
        return read_entity_csv(spark, path, entity, multi_line)
    if fmt == "json":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if fmt == "parquet":
        df = spark.read.parquet(path)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
    raise ValueError(f"unsupported raw format {fmt!r}")


def write_entity_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


# ----------------------------------------------------------------- reports
def write_report(df: DataFrame, path: str) -> str:
    """A report DataFrame as JSON lines (one file per partition)."""
    df.write.mode("overwrite").json(path)
    return path
