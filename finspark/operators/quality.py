"""Data-quality and monitoring checks as distributed aggregations.

Every check is a findings DataFrame (one row per table / column / test), so
checks over many tables run as one Spark job and can be written as a report.
No per-table driver loop touches data: the loops below only assemble plans.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finspark.config import (CAUSE_FRESHNESS, CAUSE_TESTS_FAILED, CAUSE_VOLUME_DROP, REASON_NO_HISTORY, REASON_NO_ROWS,
                             REASON_PREV_ZERO)
from finspark.functions.dates import run_date
from finspark.functions.numeric import safe_ratio
from finspark.plans.isolation import run_isolated
from finspark.plans.pipeline import Pipeline
from finspark.plans.registry import pipeline, query
from finspark.session import ensure_checkpoint_dir

# Declared schema tests: (model, column, tests).
SCHEMA_TESTS = [
    ("gold_monthly_revenue", "month", ("not_null", "unique")),
    ("gold_arr", "month", ("not_null", "unique")),
    ("gold_refund_rate", "date", ("not_null", "unique")),
    ("gold_failed_payment_rate", "date", ("not_null", "unique")),
    ("gold_cohort_retention", "cohort_month", ("not_null",)),
    ("gold_cohort_retention", "months_since_cohort", ("not_null",)),
    ("platinum_finance_exec_scorecard_daily", "date", ("not_null", "unique")),
    ("platinum_finance_exec_scorecard_monthly", "month", ("not_null", "unique")),
    ("platinum_anomalies_daily", "date", ("not_null",)),
    ("platinum_anomalies_daily", "metric_name", ("not_null",)),
] + [(f"bronze_{e}", "ingestion_date", ("not_null",))
     for e in ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")
] + [(f"bronze_{e}s", f"{e}_id", ("not_null", "unique"))
     for e in ("customer", "account", "transaction", "payment", "subscription", "refund")
] + [(f"silver_{e}s", f"{e}_id", ("unique",)) for e in ("customer", "account", "transaction", "subscription", "refund")]

# Monitored tables and the date column each one is tracked by.
MONITORED_DATE_COLUMNS = {
    "gold_transaction_facts": "created_at",
    "gold_daily_revenue": "revenue_date",
    "gold_churn": "churn_month",
    "gold_mrr": "revenue_month",
}
# Names the reference probes for, in order; the first one a table has wins.
DATE_COLUMN_CANDIDATES = ("transaction_date", "revenue_date", "churn_date", "month")

ACCEPTED_VALUES = [
    ("bronze_accounts", "account_type", ("checking", "savings", "credit")),
    ("bronze_accounts", "status", ("active", "closed", "suspended")),
    ("bronze_transactions", "status", ("success", "failed", "pending")),
    ("bronze_payments", "payment_method", ("card", "bank")),
    ("bronze_payments", "status", ("success", "failed")),
    ("bronze_subscriptions", "plan_name", ("basic", "pro", "enterprise")),
    ("bronze_subscriptions", "status", ("active", "paused", "canceled")),
    ("bronze_refunds", "refund_reason", ("customer_dispute", "merchant_error", "duplicate_charge")),
]

REFERENCES = [
    ("silver_accounts", "customer_id", "silver_customers", "customer_id"),
    ("silver_transactions", "account_id", "silver_accounts", "account_id"),
    ("silver_transactions", "customer_id", "silver_customers", "customer_id"),
    ("silver_payments", "transaction_id", "silver_transactions", "transaction_id"),
    ("silver_refunds", "transaction_id", "silver_transactions", "transaction_id"),
    ("silver_subscriptions", "customer_id", "silver_customers", "customer_id"),
]

GRAINS = [
    ("platinum_anomalies_daily", ("date", "metric_name")),
    ("gold_cohort_retention", ("cohort_month", "months_since_cohort")),
    ("gold_mrr", ("revenue_month",)),
    ("gold_churn", ("churn_month",)),
    ("bronze_payments", ("transaction_id", "attempt_number")),
    ("bronze_refunds", ("transaction_id", "amount", "refund_reason", "refunded_at")),
]

DAILY_MODELS = [("gold_daily_revenue", "revenue_date"), ("platinum_finance_exec_scorecard_daily", "date")]


def layer_order(model: str) -> tuple:
    """Models in the order of their layers, so that later ones read what earlier ones wrote."""
    return (("bronze", "silver", "gold", "platinum").index(model.split("_")[0]), model != "gold_transaction_facts", model)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _status(failures) -> F.Column:
    return F.when(failures > 0, "fail").otherwise("pass")


def _measured(p: Pipeline, metric: str, wanted: dict[tuple[str, str], tuple], names: str) -> DataFrame | None:
    """(names..., value) of what a finished run has measured of ``wanted`` (model, column) -> literals."""
    rows = [(m, c, *more) for (m, c), more in wanted.items() if m in p.measured]
    if not rows:
        return None
    asked = p.spark.createDataFrame(rows, names)  # the declared checks
    got = p.metrics.where(F.col("metric") == metric).select("model_name", "column_name", "value")
    return F.broadcast(asked).join(got, ["model_name", "column_name"])


def not_null_checks(p: Pipeline, tests=SCHEMA_TESTS) -> DataFrame:
    """One aggregation pass per model counts NULLs in all its tested columns; none for a model
    that a finished run has measured."""
    by_model: dict[str, list[str]] = {}
    for m, c, kinds in tests:
        if "not_null" in kinds and m not in p.measured:
            by_model.setdefault(m, []).append(c)
    known = _measured(p, "nulls", {(m, c): ("not_null",) for m, c, kinds in tests if "not_null" in kinds},
                      "model_name string, column_name string, test_name string")
    parts = [] if known is None else [known.select("model_name", "column_name", "test_name", F.col("value").alias("failures"))]
    for m, cols in by_model.items():
        counts = p.ref(m).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("model_name"), F.lit(c).alias("column_name"),
                     F.lit("not_null").alias("test_name"), F.col(c).alias("failures"))
            for c in cols])).alias("r")).select("r.*"))
    out = union_all(parts)
    return out.withColumn("status", _status(F.col("failures")))


def unique_checks(p: Pipeline, tests=SCHEMA_TESTS) -> DataFrame:
    """Failures = number of non-null values that occur more than once."""
    known = _measured(p, "repeated", {(m, c): ("unique",) for m, c, kinds in tests if "unique" in kinds},
                      "model_name string, column_name string, test_name string")
    parts = [] if known is None else [known.select("model_name", "column_name", "test_name", F.col("value").alias("failures"))]
    for m, c, kinds in tests:
        if "unique" not in kinds or m in p.measured:
            continue
        dup = (p.ref(m).where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("failures")))
        parts.append(dup.select(F.lit(m).alias("model_name"), F.lit(c).alias("column_name"),
                                F.lit("unique").alias("test_name"), "failures"))
    return union_all(parts).withColumn("status", _status(F.col("failures")))


def schema_tests(p: Pipeline) -> DataFrame:
    return not_null_checks(p).unionByName(unique_checks(p))


def date_column(df: DataFrame, own: str) -> str:
    """The column a table is tracked by: the first candidate it has, else its own."""
    return next((x for x in DATE_COLUMN_CANDIDATES if x in df.columns), own)


def monitored_dates(p: Pipeline, tables=MONITORED_DATE_COLUMNS) -> tuple[DataFrame, dict[str, str]]:
    """(table_name, d) for every row of every monitored table, and the
    tables that could not be read (name -> error), which the checks report
    as ``error`` rows instead of failing the whole run."""
    parts, errors = [], {}
    for t, col in tables.items():
        try:
            df = p.ref(t)
            parts.append(df.select(F.lit(t).alias("table_name"), F.to_date(F.col(date_column(df, col))).alias("d")))
        except Exception as e:  # missing table / column: isolate this table
            errors[t] = str(e)
    if not parts:
        return p.spark.createDataFrame([], "table_name string, d date"), errors
    return union_all(parts), errors


def daily_counts(p: Pipeline, tables=MONITORED_DATE_COLUMNS) -> tuple[DataFrame, dict[str, str]]:
    """(table_name, d, n): rows per table and day, as volume and freshness each read them."""
    dates, errors = monitored_dates(p, {t: c for t, c in tables.items() if t not in p.measured})
    counts = dates.groupBy("table_name", "d").agg(F.count(F.lit(1)).alias("n"))
    known = [t for t in tables if t in p.measured]
    if known:
        days = p.metrics.where((F.col("metric") == "day") & F.col("model_name").isin(known)).select(
            F.col("model_name").alias("table_name"), F.col("day").alias("d"), F.col("value").alias("n"))
        counts = days if len(known) == len(tables) else counts.union(days)
    return counts, errors


def _table_list_with_errors(p: Pipeline, tables, errors: dict[str, str]) -> DataFrame:
    schema = T.StructType([T.StructField("table_name", T.StringType(), False),
                           T.StructField("error", T.StringType(), True)])
    return p.spark.createDataFrame([(t, errors.get(t)) for t in tables], schema)


def volume_checks(p: Pipeline, tables=MONITORED_DATE_COLUMNS) -> DataFrame:
    """Row counts of each table's two latest dates and the % change."""
    daily, errors = daily_counts(p, tables)
    w = Window.partitionBy("table_name").orderBy(F.col("d").desc_nulls_last())
    top2 = daily.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= 2)
    piv = top2.groupBy("table_name").agg(
        F.max(F.when(F.col("rn") == 1, F.col("d"))).alias("latest_date"),
        F.max(F.when(F.col("rn") == 1, F.col("n"))).alias("latest_count"),
        F.max(F.when(F.col("rn") == 2, F.col("d"))).alias("prev_date"),
        F.max(F.when(F.col("rn") == 2, F.col("n"))).alias("prev_count"),
        F.count(F.lit(1)).alias("n_days"))
    j = _table_list_with_errors(p, list(tables), errors).join(piv, "table_name", "left")
    pct = safe_ratio(F.col("latest_count") - F.col("prev_count"), "prev_count")
    cfg = p.config
    status = (F.when(F.col("error").isNotNull(), "error")
              .when(F.coalesce(F.col("n_days"), F.lit(0)) < 2, "skip")
              .when(F.col("prev_count") == 0, "warn")
              .when(pct < -cfg.max_volume_drop_pct, "fail")
              .when(pct > cfg.max_volume_spike_pct, "warn")
              .otherwise("pass"))
    reason = (F.when(F.col("error").isNotNull(), F.col("error"))
              .when(F.coalesce(F.col("n_days"), F.lit(0)) < 2, REASON_NO_HISTORY)
              .when(F.col("prev_count") == 0, REASON_PREV_ZERO))
    return j.select("table_name", status.alias("status"), reason.alias("reason"), "latest_date",
                    "latest_count", "prev_date", "prev_count", F.round(pct, 6).alias("pct_change"))


VOLUME_SCHEMA = ("table_name string, status string, reason string, latest_date date, latest_count bigint, prev_date date, "
                 "prev_count bigint, pct_change double")


def isolated_volume_checks(p: Pipeline, tables=MONITORED_DATE_COLUMNS) -> DataFrame:
    """``volume_checks`` with a job for each table: a table that fails while it is read is one ``error`` row."""
    checks = {t: (lambda t=t, c=c: volume_checks(p, {t: c})) for t, c in tables.items()}
    return run_isolated(p.spark, checks, lambda t, text: (t, "error", text, *[None] * 5), VOLUME_SCHEMA)


def with_cut_file(p: Pipeline, model: str, path: str) -> Pipeline:
    """``p`` with ``model`` written to ``path`` and the second half of one of its files lost."""
    spark = p.spark
    p.ref(model).coalesce(1).write.mode("overwrite").parquet(path)
    whole = spark.read.parquet(path)
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    file = hadoop.fs.Path(whole.inputFiles()[0])
    fs = file.getFileSystem(conf)
    half = fs.getFileStatus(file).getLen() // 2
    source = fs.open(file)
    kept = bytearray(source.readNBytes(half))
    source.close()
    out = fs.create(file, True)
    out.write(kept)
    out.close()
    p.override(model, spark.read.schema(whole.schema).parquet(path))
    return p


def freshness_checks(p: Pipeline, tables=MONITORED_DATE_COLUMNS) -> DataFrame:
    daily, errors = daily_counts(p, tables)
    mx = daily.groupBy("table_name").agg(F.max("d").alias("max_date"))
    j = _table_list_with_errors(p, list(tables), errors).join(mx, "table_name", "left")
    days_old = F.date_diff(run_date(p.config.as_of), F.col("max_date")).cast("bigint")
    status = (F.when(F.col("error").isNotNull(), "error").when(F.col("max_date").isNull(), "fail")
              .when(days_old <= p.config.max_freshness_days, "pass").otherwise("fail"))
    return j.select("table_name", status.alias("status"),
                    F.when(F.col("error").isNotNull(), F.col("error"))
                    .when(F.col("max_date").isNull(), REASON_NO_ROWS).alias("reason"),
                    "max_date", days_old.alias("days_old"))




def validation_status(p: Pipeline) -> DataFrame:
    """Overall status + likely causes, from the three check families (one
    union of per-check flags, one global aggregate)."""
    flags = union_all([
        schema_tests(p).select(F.lit("tests").alias("family"), (F.col("failures") > 0).alias("is_fail"),
                               F.lit(False).alias("is_warn")),
        volume_checks(p).select(F.lit("volume").alias("family"), (F.col("status") == "fail").alias("is_fail"),
                                F.col("status").isin("warn", "error").alias("is_warn")),
        freshness_checks(p).select(F.lit("freshness").alias("family"),
                                   (F.col("status") == "fail").alias("is_fail"),
                                   F.col("status").isin("warn", "error").alias("is_warn")),
    ])

    def any_of(family: str, col: str) -> F.Column:
        return F.coalesce(F.max(F.when(F.col("family") == family, F.col(col))), F.lit(False))

    j = flags.agg(any_of("tests", "is_fail").alias("tests_failed"), any_of("volume", "is_fail").alias("vol_fail"),
                  any_of("freshness", "is_fail").alias("fresh_fail"),
                  F.max(F.col("is_warn")).alias("any_warn"))
    causes = F.concat_ws(" | ",
                         F.when(F.col("tests_failed"), F.lit(CAUSE_TESTS_FAILED)),
                         F.when(F.col("vol_fail"), F.lit(CAUSE_VOLUME_DROP)),
                         F.when(F.col("fresh_fail"), F.lit(CAUSE_FRESHNESS)))
    status = (F.when(F.col("tests_failed") | F.col("vol_fail") | F.col("fresh_fail"), "fail")
              .when(F.col("any_warn"), "warn").otherwise("pass"))
    return j.select(status.alias("status"), "tests_failed", "vol_fail", "fresh_fail",
                    causes.alias("likely_causes"))


def accepted_values_checks(p: Pipeline, rules=ACCEPTED_VALUES) -> DataFrame:
    by_model: dict[str, list] = {}
    for m, c, vals in rules:
        if m not in p.measured:
            by_model.setdefault(m, []).append((c, vals))
    known = _measured(p, "invalid", {(m, c): (",".join(vals),) for m, c, vals in rules},
                      "model_name string, column_name string, accepted_values string")
    parts = [] if known is None else [known.select("model_name", "column_name", "accepted_values", F.col("value").alias("invalid_rows"))]
    for m, rs in by_model.items():
        counts = p.ref(m).agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*vals)).alias(c)
                                for c, vals in rs])
        parts.append(counts.select(F.explode(F.array(*[
            F.struct(F.lit(m).alias("model_name"), F.lit(c).alias("column_name"),
                     F.lit(",".join(vals)).alias("accepted_values"), F.col(c).alias("invalid_rows"))
            for c, vals in rs])).alias("r")).select("r.*"))
    return union_all(parts).withColumn("status", _status(F.col("invalid_rows")))


def referential_checks(p: Pipeline, refs=REFERENCES) -> DataFrame:
    """Child rows whose key is missing in the parent.  Child keys are
    counted first (map-side combine), so the anti join sees one row per
    distinct key however many child rows share it."""
    parts = []
    for child, ck, parent, pk in refs:
        keys = p.ref(parent).select(F.col(pk).alias(ck)).distinct()
        child_keys = (p.ref(child).where(F.col(ck).isNotNull())
                      .groupBy(ck).agg(F.count(F.lit(1)).alias("n")))
        orphans = child_keys.join(keys, ck, "left_anti").agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_rows"))
        parts.append(orphans.select(F.lit(child).alias("child_table"), F.lit(ck).alias("child_column"),
                                    F.lit(parent).alias("parent_table"), "orphan_rows"))
    return union_all(parts).withColumn("status", _status(F.col("orphan_rows")))


def grain_checks(p: Pipeline, grains=GRAINS) -> DataFrame:
    parts = []
    for m, cols in grains:
        dup = (p.ref(m).groupBy(*cols).count().where(F.col("count") > 1)
               .agg(F.count(F.lit(1)).alias("duplicate_groups")))
        parts.append(dup.select(F.lit(m).alias("model_name"), F.lit(",".join(cols)).alias("grain"),
                                "duplicate_groups"))
    return union_all(parts).withColumn("status", _status(F.col("duplicate_groups")))


def missing_days(p: Pipeline, models=DAILY_MODELS) -> DataFrame:
    """Calendar days between a model's first and last date with no row."""
    parts = []
    for m, col in models:
        days = p.ref(m).select(F.to_date(F.col(col)).alias("d")).where(F.col("d").isNotNull())
        cal = days.agg(F.min("d").alias("lo"), F.max("d").alias("hi")).select(
            F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("d"))
        gaps = cal.join(days.distinct(), "d", "left_anti")
        parts.append(gaps.select(F.lit(m).alias("model_name"), F.col("d").alias("missing_date")))
    return union_all(parts)


def _p(spark, sf_dir) -> Pipeline:
    return pipeline(spark, sf_dir)


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return not_null_checks(_p(spark, sf_dir))


@query("dq_unique")
def dq_unique(spark, sf_dir):
    return unique_checks(_p(spark, sf_dir))


@query("dq_volume")
def dq_volume(spark, sf_dir):
    return volume_checks(_p(spark, sf_dir))


@query("dq_volume_isolated")
def dq_volume_isolated(spark, sf_dir):
    """Volume checks as jobs of their own over a run in which one of gold_churn's files was cut short."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    return isolated_volume_checks(with_cut_file(_p(spark, sf_dir), "gold_churn", path)).drop("reason")


@query("dq_freshness")
def dq_freshness(spark, sf_dir):
    return freshness_checks(_p(spark, sf_dir))


@query("dq_status")
def dq_status(spark, sf_dir):
    return validation_status(_p(spark, sf_dir))


@query("dq_measured_status")
def dq_measured_status(spark, sf_dir):
    """The same verdict from a finished run: its layers are written and measured, and the checks
    read the measurements alone."""
    from finspark.plans.metrics import use_metrics, write_measured
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/measured-{uuid.uuid4().hex}"
    p = _p(spark, sf_dir)
    for m in sorted({m for m, _, _ in SCHEMA_TESTS} | set(MONITORED_DATE_COLUMNS), key=layer_order):
        write_measured(p, m, f"{out}/{m}", f"{out}/metrics")
    return validation_status(use_metrics(p, f"{out}/metrics"))


@query("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    return accepted_values_checks(_p(spark, sf_dir))


@query("dq_referential")
def dq_referential(spark, sf_dir):
    return referential_checks(_p(spark, sf_dir))


@query("dq_grain")
def dq_grain(spark, sf_dir):
    return grain_checks(_p(spark, sf_dir))


@query("dq_missing_days")
def dq_missing_days(spark, sf_dir):
    return missing_days(_p(spark, sf_dir))
