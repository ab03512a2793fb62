"""Incident-triage queries from the runbooks, as whole-table Spark jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from finspark.functions.dates import day_of, month_start
from finspark.functions.quantiles import quantiles
from finspark.operators.platinum import anomalies
from finspark.plans.pipeline import Pipeline, for_output
from finspark.plans.registry import pipeline, query, round_columns
from finspark.session import ensure_checkpoint_dir


def _p(spark, sf_dir) -> Pipeline:
    return pipeline(spark, sf_dir)


@query("triage_revenue_layers")
def triage_revenue_layers(spark, sf_dir):
    """Per day and layer, how many rows exist (find where a day goes missing)."""
    p = _p(spark, sf_dir)
    layers = [
        ("bronze_transactions", p.ref("bronze_transactions").select(day_of("created_at").alias("date"))),
        ("silver_transactions", p.ref("silver_transactions").select(day_of("created_at").alias("date"))),
        ("gold_transaction_facts", p.ref("gold_transaction_facts").select(day_of("created_at").alias("date"))),
        ("gold_transaction_facts_paid", p.ref("gold_transaction_facts").where(F.col("is_paid"))
         .select(day_of("created_at").alias("date"))),
        ("gold_daily_revenue", p.ref("gold_daily_revenue").select(F.col("revenue_date").alias("date"))),
        ("platinum_scorecard_daily", p.ref("platinum_finance_exec_scorecard_daily").select("date")),
    ]
    u = reduce(lambda a, b: a.unionByName(b), [df.withColumn("layer", F.lit(n)) for n, df in layers])
    return u.groupBy("date", "layer").agg(F.count(F.lit(1)).alias("row_count"))


@query("triage_refund_distribution")
def triage_refund_distribution(spark, sf_dir):
    """Histogram of per-transaction refunded amounts by order of magnitude
    (number of integer digits), with count / sum / min / max and exact percentiles per bucket.

    Amounts are whole cents; percentiles come from counting passes over them, so no bucket's
    amounts meet in one task."""
    amount = F.col("refunded_amount")
    ensure_checkpoint_dir(spark)
    refunded = _p(spark, sf_dir).ref("gold_transaction_facts").where(amount > 0).select(
        F.length(F.floor(amount).cast("string")).cast("bigint").alias("integer_digits"), amount,
        (amount * 100).cast("bigint").alias("cents")).checkpoint()  # read by every pass
    facts = refunded.groupBy("integer_digits").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("refunded_amount").alias("total_refunded"),
        F.min("refunded_amount").alias("min_refunded"), F.max("refunded_amount").alias("max_refunded"))
    cuts = quantiles(refunded, "integer_digits", "cents", {"median_refunded": 0.5, "p95_refunded": 0.95},
                     cut=lambda x: x.checkpoint())
    return for_output(facts.join(cuts, "integer_digits").withColumns(
        {c: F.round(F.col(c) / 100, 2) for c in ("median_refunded", "p95_refunded")}))


#: Refunds of the largest-refunds report.
LARGEST_REFUNDS = 50


@query("triage_largest_refunds")
def triage_largest_refunds(spark, sf_dir):
    """The largest refunds with their transactions; every task keeps its own top rows, and the few
    that are left are broadcast to the transactions.  A refund without a transaction stays."""
    p = _p(spark, sf_dir)
    top = (p.ref("silver_refunds").select("refund_id", "transaction_id", F.col("amount").alias("refund_amount"), "refund_reason")
           .orderBy(F.col("refund_amount").desc_nulls_last(), "refund_id").limit(LARGEST_REFUNDS).checkpoint())
    t = p.ref("silver_transactions").select("transaction_id", "customer_id", F.col("amount").alias("transaction_amount"))
    held = t.join(F.broadcast(top.select("transaction_id").distinct()), "transaction_id", "left_semi")
    return for_output(top.join(held, "transaction_id", "left"))


@query("triage_duplicate_refunds")
def triage_duplicate_refunds(spark, sf_dir):
    r = _p(spark, sf_dir).ref("silver_refunds")
    g = r.groupBy("transaction_id", "amount", "refund_reason", "refunded_at").agg(
        F.count(F.lit(1)).alias("copies"))
    return for_output(g.where(F.col("copies") > 1))


@query("triage_payment_retries")
def triage_payment_retries(spark, sf_dir):
    """Status distribution per attempt number plus retry-sequencing faults.

    * gap rows: an attempt whose number is neither the transaction's first
      nor one more than an existing attempt, plus every repeat of an
      attempt number already seen;
    * out-of-order rows: an attempt timed before the latest attempt k - 1.

    Written without a per-transaction window: attempts are aggregated per
    (transaction, attempt number) first (copies collapse map-side) and
    compared with attempt k - 1 through a 1:1 join, so a transaction holding
    a large share of all attempts is spread over its attempt numbers.
    """
    b = _p(spark, sf_dir).ref("bronze_payments")
    per_attempt = b.groupBy("transaction_id", "attempt_number").agg(
        F.count(F.lit(1)).alias("copies"), F.max("attempted_at").alias("latest_at"))
    first = b.groupBy("transaction_id").agg(F.min("attempt_number").alias("first_attempt"))
    prev = per_attempt.select("transaction_id", (F.col("attempt_number") + 1).alias("attempt_number"),
                              F.col("latest_at").alias("prev_latest_at"))
    flags = (per_attempt.join(first, "transaction_id").join(prev, ["transaction_id", "attempt_number"], "left")
             .select("transaction_id", "attempt_number", "prev_latest_at",
                     ((F.col("copies") - 1) + F.when((F.col("attempt_number") > F.col("first_attempt"))
                                                     & F.col("prev_latest_at").isNull(), F.col("copies"))
                      .otherwise(0)).alias("gap_rows")))
    rows = b.select("transaction_id", "attempt_number", "status", "attempted_at").join(
        flags, ["transaction_id", "attempt_number"])
    per_k = rows.groupBy("attempt_number").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.count_if(F.col("status") == "success").alias("successes"),
        F.count_if(F.col("status") != "success").alias("failures"),
        F.count_if(F.col("attempted_at") < F.col("prev_latest_at")).alias("out_of_order_rows"))
    gaps = flags.groupBy("attempt_number").agg(F.sum("gap_rows").cast("bigint").alias("gap_rows"))
    return per_k.join(gaps, "attempt_number").select(
        "attempt_number", "attempts", "successes", "failures", "gap_rows", "out_of_order_rows")


@query("triage_churn_distribution")
def triage_churn_distribution(spark, sf_dir):
    s = _p(spark, sf_dir).ref("silver_subscriptions").where(
        (F.col("status") == "canceled") & F.col("end_date").isNotNull())
    g = s.groupBy(month_start("end_date").alias("churn_month")).agg(
        F.count(F.lit(1)).alias("canceled_subscriptions"),
        F.count_distinct("customer_id").alias("customers"))
    return g.select("*", (F.col("canceled_subscriptions") - F.col("customers")).alias("duplicate_cancellations"))


@query("triage_window_completeness")
def triage_window_completeness(spark, sf_dir):
    """Per day: how many rows the trailing 30-row baseline holds and how many
    calendar days it spans (gaps make "30 rows" cover more than 30 days)."""
    d = _p(spark, sf_dir).ref("platinum_finance_exec_scorecard_daily").select("date")
    w = Window.orderBy("date").rowsBetween(-30, -1)
    x = d.select("date", F.count(F.lit(1)).over(w).alias("history_rows"),
                 F.min("date").over(w).alias("history_start"))
    span = F.date_diff("date", "history_start").cast("bigint")
    return x.select("date", "history_rows", span.alias("history_span_days"),
                    ((F.col("history_rows") == 30) & (span == 30)).alias("is_complete"))


@query("triage_anomalies_complete_days")
def triage_anomalies_complete_days(spark, sf_dir):
    """Anomaly flags with the latest (possibly partial) day left out."""
    daily = _p(spark, sf_dir).ref("platinum_finance_exec_scorecard_daily")
    complete = daily.where(F.col("date") < daily.select(F.max("date")).scalar())
    return round_columns(anomalies(complete), {"metric_value": 6, "baseline_value": 4, "z_score": 4})
