"""Incremental bronze loads and report sinks.

An incremental run takes the high-water mark (``ingestion_date``) from the table's manifest, keeps
the batch rows at or after it, replaces target rows whose key the batch carries
(delete + insert) and puts the next version in place (:mod:`finspark.sources.manifest`).
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.config import FINDING_PII_VALUE, FINDING_SCAN_ERROR
from finspark.operators.bronze import ENTITY_KEYS, with_load_time
from finspark.operators.compliance import ALL_LAYERS, compliance_status, pii_column_findings, pii_value_findings
from finspark.operators.insight import finance_insight
from finspark.operators.macros import since_mark
from finspark.operators.quality import freshness_checks, schema_tests, validation_status, volume_checks
from finspark.plans.catalog import LAYER_MODELS
from finspark.plans.pipeline import Pipeline, for_output
from finspark.plans.registry import pipeline, query
from finspark.session import ensure_checkpoint_dir
from finspark.sources.files import CSV_OPTIONS, ENTITY_SCHEMAS, load_entity_csv, read_entity_csv, write_entity_csv, write_report
from finspark.sources.manifest import ManifestTable


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bronze_table(spark: SparkSession, table: str, entity: str) -> ManifestTable:
    return ManifestTable(spark, table, ENTITY_KEYS[entity])


def load_bronze(spark: SparkSession, batch: DataFrame, table: str, entity: str, lookback_days: int = 0,
                mode: str = "upsert") -> DataFrame:
    """One incremental run of a bronze table; returns the new version.

    ``mode="upsert"`` replaces rows whose key the batch carries (the default) and rewrites only
    the files that can hold one; ``mode="append"`` keeps every row ever loaded, duplicates included."""
    if mode not in ("upsert", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    target = bronze_table(spark, table, entity)
    batch = batch.select(*ENTITY_SCHEMAS[entity].fieldNames())
    if target.version():
        batch = since_mark(batch, target.high_water_mark(), "ingestion_date", lookback_days)
    fresh = with_load_time(batch, "bronze_loaded_at")
    target.merge(fresh) if mode == "upsert" else target.append(fresh)
    return target.read()


# First load of the upsert demonstration: rows ingested before this day.
UPSERT_FIRST_LOAD_BEFORE = dt.date(1998, 1, 1)


@query("bronze_upsert")
def bronze_upsert_q(spark, sf_dir):
    """Two incremental runs of bronze_transactions: the first load holds the
    rows ingested before 1998, the second run re-reads the whole source."""
    p = pipeline(spark, sf_dir)
    src = p.raw("transactions")
    table = scratch_dir(spark, "bronze-transactions")
    load_bronze(spark, src.where(F.col("ingestion_date") < F.lit(UPSERT_FIRST_LOAD_BEFORE)), table, "transactions")
    return for_output(load_bronze(spark, src, table, "transactions"))


@query("src_csv_scan")
def src_csv_scan_q(spark, sf_dir):
    """Raw transactions written as CSV and read back with the fixed schema."""
    path = scratch_dir(spark, "raw-transactions-csv")
    write_entity_csv(pipeline(spark, sf_dir).raw("transactions"), path)
    return for_output(read_entity_csv(spark, path, "transactions"))


def landed_csv(spark: SparkSession, raw: DataFrame, entity: str, path: str) -> None:
    """Raw rows as CSV lines without header, and beside each row whose key ends in 7 a line that
    is no row: the key and two words."""
    raw.write.mode("overwrite").options(**CSV_OPTIONS).option("header", False).csv(f"{path}/rows")
    key = F.col(ENTITY_KEYS[entity])
    raw.where(key.endswith("7")).select(F.concat(key, F.lit(",cut off"))).write.mode("overwrite").text(f"{path}/cut")


def _quarantined_load(spark: SparkSession, sf_dir: str, entity: str) -> tuple[DataFrame, DataFrame]:
    """(rows, lines set aside) of an entity landed as CSV."""
    root = scratch_dir(spark, f"raw-{entity}-csv")
    landed_csv(spark, pipeline(spark, sf_dir).raw(entity), entity, f"{root}/landing")
    return load_entity_csv(spark, [f"{root}/landing/rows", f"{root}/landing/cut"], entity, f"{root}/staging",
                           max_bad_share=0.25, header=False)


def _csv_query(entity: str) -> None:
    @query(f"src_csv_{entity}")
    def run(spark, sf_dir):
        return for_output(_quarantined_load(spark, sf_dir, entity)[0])


for _entity in ENTITY_SCHEMAS:
    _csv_query(_entity)


@query("src_csv_quarantine")
def src_csv_quarantine_q(spark, sf_dir):
    """The lines of all six entities that were set aside, whole."""
    return reduce(DataFrame.unionByName, (_quarantined_load(spark, sf_dir, e)[1] for e in ENTITY_SCHEMAS)).select("entity", "line")


def _report_roundtrip(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = write_report(df, scratch_dir(spark, name))
    return spark.read.json(path)


def gather(frames: dict[str, DataFrame]) -> DataFrame:
    """One row holding ``collect_list`` of each frame's rows, from a tagged
    union and a single global aggregate (no joins between the frames)."""
    names = list(frames)
    tagged = None
    for n, df in frames.items():
        row = df.select(*[(F.struct(*[F.col(c) for c in df.columns]) if m == n else F.lit(None)).alias(m)
                          for m in names])
        tagged = row if tagged is None else tagged.unionByName(row, allowMissingColumns=True)
    return tagged.agg(*[F.collect_list(n).alias(n) for n in names])


def validation_report(p: Pipeline) -> DataFrame:
    """One nested row: status, run times, schema-test summary, volume /
    freshness checks and likely causes."""
    import datetime as _dt
    started = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    g = gather({"status": validation_status(p), "tests": schema_tests(p), "volume_checks": volume_checks(p),
                "freshness_checks": freshness_checks(p)})
    st = F.element_at("status", 1)
    failed = F.filter("tests", lambda t: t["status"] == "fail")
    return g.select(st["status"].alias("status"),
                    F.lit(started).alias("started_at"),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("finished_at"),
                    F.struct(F.size("tests").alias("tests"), F.size(failed).alias("failed_tests"),
                             F.transform(failed, lambda t: F.concat_ws(".", t["model_name"], t["column_name"],
                                                                       t["test_name"])).alias("failed"))
                    .alias("test_summary"),
                    "volume_checks", "freshness_checks",
                    F.filter(F.split(st["likely_causes"], r" \| "), lambda c: c != "").alias("likely_causes"))


@query("report_validation")
def report_validation_q(spark, sf_dir):
    return _report_roundtrip(spark, validation_report(pipeline(spark, sf_dir)), "validation-report")


@query("report_insight")
def report_insight_q(spark, sf_dir):
    return _report_roundtrip(spark, finance_insight(pipeline(spark, sf_dir)), "daily-finance-insights")


@query("report_compliance")
def report_compliance_q(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    cols = pii_column_findings(spark, p).select("object", "type", "evidence", "severity")
    vals = pii_value_findings(spark, p).where("finding").select(
        "object", F.when(F.col("scan_error").isNotNull(), FINDING_SCAN_ERROR).otherwise(FINDING_PII_VALUE).alias("type"),
        F.coalesce("scan_error", F.to_json(F.struct("email_detected", "phone_detected", "sampled_columns"))).alias("evidence"),
        F.lit("warn").alias("severity"))
    g = gather({"summary": compliance_status(spark, p), "findings": cols.unionByName(vals)})
    s = F.element_at("summary", 1)
    checked = [f"{layer}.{m}" for layer in ALL_LAYERS for m in LAYER_MODELS[layer]]
    report = g.select(s["status"].alias("status"), F.array(*[F.lit(c) for c in checked]).alias("checked_objects"),
                      "findings")
    return _report_roundtrip(spark, report, "compliance-report")


@query("stream_bronze_ingest")
def stream_bronze_ingest_q(spark, sf_dir):
    from finspark.streaming.ingest import stream_bronze_demo
    raw = pipeline(spark, sf_dir).raw("transactions")
    return for_output(stream_bronze_demo(spark, raw, "transactions", scratch_dir(spark, "stream-bronze")))


@query("stream_latest_state")
def stream_latest_state_q(spark, sf_dir):
    """The latest row per transaction from a stream with late and repeated rows, kept in bounded state."""
    from finspark.streaming.latest import stream_latest_demo
    return for_output(stream_latest_demo(spark, pipeline(spark, sf_dir).raw("transactions"), scratch_dir(spark, "stream-latest")))


@query("stream_event_counts")
def stream_event_counts_q(spark, sf_dir):
    from finspark.sources.tables import read_table
    from finspark.streaming.ingest import stream_event_counts
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return stream_event_counts(spark, ev, scratch_dir(spark, "stream-events"))
