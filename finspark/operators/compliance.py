"""PII compliance scans.

* Column-name scan over the model schemas; catalog listing of published views
  (metadata only).
* Value-pattern scan: every row and string column of a table in one
  aggregation (no sort), values concatenated per row and matched with the
  e-mail / phone patterns (JVM regex), ``bool_or``; a sample is an option.
* A table that cannot be read yields a ``scan_error`` finding with the whole
  error text; the other tables are scanned.
* Text scan at scale: the same two patterns counted over every document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.config import (COMPLIANCE_SAMPLE_COLUMNS, COMPLIANCE_SAMPLE_ROWS, EMAIL_PATTERN,
                             FINDING_PII_COLUMN, PHONE_PATTERN, PII_COLUMN_HINTS)
from finspark.plans.catalog import LAYER_MODELS, publish
from finspark.plans.isolation import run_isolated
from finspark.plans.pipeline import Pipeline
from finspark.plans.registry import pipeline, query
from finspark.sources.tables import read_table

DEFAULT_LAYERS = ("gold", "platinum")
ALL_LAYERS = ("bronze", "silver", "gold", "platinum")

def catalog_columns(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS) -> DataFrame:
    """(layer, table_name, column_name, data_type, ordinal) via the catalog."""
    views = publish(p, layers)
    rows = []
    for layer, name in views:
        for i, c in enumerate(spark.catalog.listColumns(name)):
            rows.append((layer, name, c.name, c.dataType, i))
    schema = "layer string, table_name string, column_name string, data_type string, ordinal int"
    return spark.createDataFrame(rows, schema)


def schema_columns(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS) -> DataFrame:
    """Same rows as :func:`catalog_columns`, read from the model schemas
    (metadata only, no catalog round trips); models that cannot be read are left out."""
    rows = [(*obj.split("."), f.name, f.dataType.simpleString(), i)
            for obj, df in model_frames(p, layers)[0].items() for i, f in enumerate(df.schema.fields)]
    schema = "layer string, table_name string, column_name string, data_type string, ordinal int"
    return spark.createDataFrame(rows, schema)


def pii_column_findings(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS) -> DataFrame:
    cols = schema_columns(spark, p, layers)
    hits = cols.where(F.lower("column_name").isin(*PII_COLUMN_HINTS))
    return (hits.groupBy("layer", "table_name")
            .agg(F.array_join(F.sort_array(F.collect_list("column_name")), ",").alias("evidence"))
            .select(F.concat_ws(".", "layer", "table_name").alias("object"),
                    F.lit(FINDING_PII_COLUMN).alias("type"), "evidence", F.lit("fail").alias("severity")))


def model_frames(p: Pipeline, layers=ALL_LAYERS) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """The models of the layers by "layer.model", and the error texts of those that cannot be planned
    (missing tables, columns and paths).  Faults met while rows are read are found by
    :func:`isolated_value_findings`."""
    frames, errors = {}, {}
    for layer in layers:
        for m in LAYER_MODELS[layer]:
            try:
                frames[f"{layer}.{m}"] = p.ref(m)
            except Exception as e:  # noqa: BLE001  any failure of one table is a finding
                errors[f"{layer}.{m}"] = str(e)
    return frames, errors


def scanned_columns(df: DataFrame, strict_compat: bool = False, sample: bool = False) -> list[str]:
    """Columns eligible for the value scan; only the first six of them in a sample.

    Compatibility mode drops every name containing "id" (also ``is_paid``,
    ``paid_amount``) and keeps every type.  Default mode drops only ``id`` /
    ``*_id`` names and samples string columns: numbers and dates match the
    phone pattern by construction and would flag every table.
    """
    out = []
    for f in df.schema.fields:
        n = f.name.lower()
        if strict_compat:
            if "id" in n:
                continue
        else:
            if n == "id" or n.endswith("_id") or not isinstance(f.dataType, T.StringType):
                continue
        out.append(f.name)
    return out[:COMPLIANCE_SAMPLE_COLUMNS] if sample else out


def value_scan(name: str, df: DataFrame, strict_compat: bool = False, sample: bool = False) -> DataFrame | None:
    """E-mail / phone pattern flags for one table: over every row (a plain
    aggregation, no sort), or with ``sample`` over the first 200 rows in
    column order (a distributed top-k)."""
    cols = scanned_columns(df, strict_compat, sample)
    if not cols:
        return None
    rows = df.select(*cols)
    if sample:
        rows = rows.orderBy(*[F.col(c).asc_nulls_last() for c in cols]).limit(COMPLIANCE_SAMPLE_ROWS)
    text = F.concat_ws(" ", *[F.col(c).cast("string") for c in cols])
    return rows.agg(
        F.coalesce(F.max(text.rlike(EMAIL_PATTERN)), F.lit(False)).alias("email_detected"),
        F.coalesce(F.max(text.rlike(PHONE_PATTERN)), F.lit(False)).alias("phone_detected"),
    ).select(F.lit(name).alias("object"), "email_detected", "phone_detected",
             F.lit(",".join(cols)).alias("sampled_columns"))


def pii_value_findings(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS, strict_compat: bool | None = None
                       ) -> DataFrame:
    """One row per scanned table (tables with PII column names are skipped,
    as their finding already fails); ``finding`` marks the warn rows.
    ``strict_compat`` defaults to the pipeline's config."""
    if strict_compat is None:
        strict_compat = p.config.strict_compat
    frames, errors = model_frames(p, layers)
    parts = []
    for obj, df in frames.items():
        if any(c.lower() in PII_COLUMN_HINTS for c in df.columns):
            continue
        part = value_scan(obj, df, strict_compat, p.config.pii_sample)
        if part is not None:
            parts.append(part.withColumn("scan_error", F.lit(None).cast("string")))
    schema = "object string, email_detected boolean, phone_detected boolean, sampled_columns string, scan_error string"
    if errors or not parts:
        parts.append(spark.createDataFrame([(o, None, None, None, text) for o, text in errors.items()], schema))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("finding", F.col("scan_error").isNotNull()
                          | F.coalesce(F.col("email_detected") | F.col("phone_detected"), F.lit(False)))


FINDING_SCHEMA = "object string, email_detected boolean, phone_detected boolean, sampled_columns string, scan_error string, finding boolean"


def isolated_value_findings(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS) -> DataFrame:
    """``pii_value_findings`` with a job for each table: one that fails while it is read is a ``scan_error`` row."""
    def scan(name: str):
        df = p.ref(name.split(".")[1])
        skipped = any(c.lower() in PII_COLUMN_HINTS for c in df.columns)
        part = None if skipped else value_scan(name, df, p.config.strict_compat, p.config.pii_sample)
        if part is None:
            return spark.createDataFrame([], FINDING_SCHEMA)
        return part.withColumns({"scan_error": F.lit(None).cast("string"), "finding": F.col("email_detected") | F.col("phone_detected")})

    checks = {f"{layer}.{m}": (lambda n=f"{layer}.{m}": scan(n)) for layer in layers for m in LAYER_MODELS[layer]}
    return run_isolated(spark, checks, lambda name, text: (name, None, None, None, text, True), FINDING_SCHEMA)


def compliance_status(spark: SparkSession, p: Pipeline, layers=ALL_LAYERS) -> DataFrame:
    cols = pii_column_findings(spark, p, layers).select("object", "severity")
    vals = pii_value_findings(spark, p, layers).where("finding").select("object", F.lit("warn").alias("severity"))
    findings = cols.unionByName(vals)
    checked = sum(len(LAYER_MODELS[x]) for x in layers)
    return findings.agg(
        F.count(F.lit(1)).alias("findings"),
        F.coalesce(F.max(F.col("severity") == "fail"), F.lit(False)).alias("any_fail"),
    ).select(
        F.when(F.col("any_fail"), "fail").when(F.col("findings") > 0, "warn").otherwise("pass").alias("status"),
        F.lit(checked).cast("bigint").alias("checked_objects"), "findings")


def pii_scan_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail / phone pattern matches over every document's full text."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    emails = F.size(F.regexp_extract_all("text", F.lit(EMAIL_PATTERN), 0))
    phones = F.size(F.regexp_extract_all("text", F.lit(PHONE_PATTERN), 1))
    return d.select("doc_id", emails.cast("bigint").alias("email_matches"),
                    phones.cast("bigint").alias("phone_matches"))


@query("compliance_catalog")
def compliance_catalog_q(spark, sf_dir):
    """Tables and columns of the gold and platinum layers, as listed by the
    catalog (engine-specific type names left out)."""
    return catalog_columns(spark, pipeline(spark, sf_dir), DEFAULT_LAYERS).drop("data_type")


@query("pii_scan_columns")
def pii_scan_columns_q(spark, sf_dir):
    return pii_column_findings(spark, pipeline(spark, sf_dir))


@query("pii_scan_values")
def pii_scan_values_q(spark, sf_dir):
    return pii_value_findings(spark, pipeline(spark, sf_dir))


@query("compliance_status")
def compliance_status_q(spark, sf_dir):
    return compliance_status(spark, pipeline(spark, sf_dir))


@query("pii_scan_documents")
def pii_scan_documents_q(spark, sf_dir):
    return pii_scan_documents(spark, sf_dir)
