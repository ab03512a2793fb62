"""Documented metric definitions that differ from the coded models.

Documentation column names map onto model columns: subscription_status ->
status, event_ts / canceled_at -> end_date, final_status = 'paid' ->
is_paid, gross_amount -> transaction_amount, transaction_date ->
date(created_at), payment_date -> date(attempted_at).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finspark.functions.dates import day_of, month_start, run_date
from finspark.functions.masking import standardize_email
from finspark.functions.numeric import safe_ratio
from finspark.operators.gold import mrr_by_subscription
from finspark.operators.macros import dedupe_latest, desc_last
from finspark.operators.ordering import ranked_with_next
from finspark.plans.pipeline import Pipeline, for_output
from finspark.plans.registry import pipeline, query, round_columns


def _p(spark, sf_dir) -> Pipeline:
    return pipeline(spark, sf_dir)


def canceled(p: Pipeline) -> DataFrame:
    return p.ref("silver_subscriptions").where(F.col("status") == "canceled")


@query("doc_churn_events")
def doc_churn_events(spark, sf_dir):
    return canceled(_p(spark, sf_dir)).groupBy("subscription_id", "customer_id").agg(
        F.min("end_date").alias("churn_date"))


@query("doc_customer_churn")
def doc_customer_churn(spark, sf_dir):
    return canceled(_p(spark, sf_dir)).groupBy("customer_id").agg(F.min("end_date").alias("churn_date"))


@query("doc_daily_revenue_paid")
def doc_daily_revenue_paid(spark, sf_dir):
    f = _p(spark, sf_dir).ref("gold_transaction_facts").where(F.col("is_paid"))
    return for_output(f.groupBy(day_of("created_at").alias("revenue_date")).agg(
        F.sum("transaction_amount").alias("gross_revenue"), F.sum("refunded_amount").alias("refunded_revenue"),
        F.sum("net_amount").alias("net_revenue"), F.count(F.lit(1)).alias("transaction_count")))


@query("doc_daily_revenue_settled")
def doc_daily_revenue_settled(spark, sf_dir):
    t = _p(spark, sf_dir).ref("silver_transactions").where(
        (F.col("status") == "success") & (F.col("amount") > 0) & F.col("settled_at").isNotNull())
    return for_output(t.groupBy(day_of("created_at").alias("revenue_date")).agg(
        F.sum("amount").alias("gross_revenue"), F.count(F.lit(1)).alias("transaction_count")))


@query("doc_monthly_rollup")
def doc_monthly_rollup(spark, sf_dir):
    d = _p(spark, sf_dir).ref("gold_daily_revenue")
    return for_output(d.groupBy(month_start("revenue_date").alias("month")).agg(
        F.sum("net_revenue").alias("monthly_net_revenue")))


@query("doc_mrr_by_subscription")
def doc_mrr_by_subscription(spark, sf_dir):
    x = mrr_by_subscription(_p(spark, sf_dir))
    return x.select(F.col("revenue_month").alias("month"), "subscription_id", "customer_id",
                    F.col("plan_name").alias("plan"), F.col("monthly_price").alias("mrr_amount"))


@query("doc_arr_from_mrr")
def doc_arr_from_mrr(spark, sf_dir):
    m = _p(spark, sf_dir).ref("gold_mrr")
    return m.groupBy(F.col("revenue_month").alias("month")).agg((F.sum("mrr") * 12).alias("arr_amount"))


@query("doc_refund_rate_amount")
def doc_refund_rate_amount(spark, sf_dir):
    f = _p(spark, sf_dir).ref("gold_transaction_facts").where(F.col("is_paid"))
    g = f.groupBy(day_of("created_at").alias("date")).agg(
        F.sum("refunded_amount").alias("r"), F.sum("transaction_amount").alias("g"))
    return round_columns(g.select("date", safe_ratio("r", "g").alias("refund_rate")), {"refund_rate": 6})


@query("doc_refund_rate_count")
def doc_refund_rate_count(spark, sf_dir):
    p = _p(spark, sf_dir)
    refunded_ids = p.ref("silver_refunds").select("transaction_id").distinct().withColumn("has_refund", F.lit(1))
    t = (p.ref("silver_transactions").where(F.col("status") == "success")
         .select("transaction_id", day_of("created_at").alias("date"))
         .join(refunded_ids, "transaction_id", "left"))
    g = t.groupBy("date").agg(F.count(F.lit(1)).alias("success_transactions"),
                              F.count("has_refund").alias("refunded_transactions"))
    return round_columns(g.select("*", safe_ratio("refunded_transactions", "success_transactions")
                                  .alias("refund_rate")), {"refund_rate": 6})


@query("doc_failed_rate_attempt")
def doc_failed_rate_attempt(spark, sf_dir):
    p = _p(spark, sf_dir)
    attempts = dedupe_latest(p.ref("bronze_payments"), "payment_id",
                             desc_last("ingestion_date", "attempted_at", "status", "transaction_id"))
    g = attempts.groupBy(day_of("attempted_at").alias("date")).agg(
        F.count(F.lit(1)).alias("attempt_count"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).cast("bigint").alias("failed_count"))
    return round_columns(g.select("*", safe_ratio("failed_count", "attempt_count").alias("failed_payment_rate")),
                         {"failed_payment_rate": 6})


@query("doc_cohort_retained")
def doc_cohort_retained(spark, sf_dir):
    c = _p(spark, sf_dir).ref("gold_cohort_retention")
    return c.select("cohort_month", "months_since_cohort", F.col("customers_retained").alias("retained_customers"))


def customer_flags(p: Pipeline) -> DataFrame:
    """Per-customer facts and the four locked flags (one row per customer)."""
    f = p.ref("gold_transaction_facts")
    tx = f.groupBy("customer_id").agg(
        F.min(day_of("created_at")).alias("first_transaction_date"),
        F.sum("net_amount").alias("lifetime_revenue"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.max(F.col("is_paid")).alias("paying_customer_flag"),
        F.max(F.col("refunded_amount") > 0).alias("refunded_customer_flag"))
    active = (p.ref("silver_accounts").where(F.col("normalized_status") == "active")
              .select("customer_id").distinct().withColumn("active_customer_flag", F.lit(True)))
    churned = (p.ref("silver_subscriptions").where(F.col("status") == "canceled")
               .select("customer_id").distinct().withColumn("churned_customer_flag", F.lit(True)))
    c = p.ref("silver_customers").select("customer_id")
    j = c.join(tx, "customer_id", "left").join(active, "customer_id", "left").join(churned, "customer_id", "left")
    return j.select(
        "customer_id", "first_transaction_date",
        F.coalesce("lifetime_revenue", F.lit(0)).alias("lifetime_revenue"),
        F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"),
        *[F.coalesce(c_, F.lit(False)).alias(c_) for c_ in
          ("active_customer_flag", "paying_customer_flag", "refunded_customer_flag", "churned_customer_flag")])


@query("doc_customer_metrics")
def doc_customer_metrics(spark, sf_dir):
    return for_output(customer_flags(_p(spark, sf_dir)))


def final_status() -> F.Column:
    return (F.when((F.col("final_payment_status") == "success") & (F.col("refunded_amount") > 0), "refunded")
            .when(F.col("final_payment_status") == "success", "paid")
            .when(F.col("final_payment_status") == "failed", "failed")
            .otherwise("pending"))


def final_statuses(p: Pipeline) -> DataFrame:
    f = p.ref("gold_transaction_facts").select("transaction_id", "refunded_amount")
    pay = p.ref("silver_payments").select("transaction_id", "final_payment_status")
    return f.join(pay, "transaction_id", "left").select("transaction_id", final_status().alias("final_status"))


@query("doc_final_status")
def doc_final_status(spark, sf_dir):
    return final_statuses(_p(spark, sf_dir))


@query("doc_paying_customers")
def doc_paying_customers(spark, sf_dir):
    t = _p(spark, sf_dir).ref("silver_transactions")
    return t.where((F.col("status") == "success") & (F.col("amount") > 0)).agg(
        F.count_distinct("customer_id").alias("paying_customers"))


@query("doc_subscription_lifecycle")
def doc_subscription_lifecycle(spark, sf_dir):
    """Each customer's subscriptions in start order: sequence number, next
    start date, overlap with the next one (skew-safe ordered rank)."""
    p = _p(spark, sf_dir)
    s = p.ref("silver_subscriptions").select("subscription_id", "customer_id", "status", "start_date", "end_date")
    x = ranked_with_next(s, "customer_id", ["start_date", "subscription_id"], "start_date")
    eff_end = F.coalesce("end_date", run_date(p.config.as_of))
    return x.select("subscription_id", "customer_id", "status", "start_date", "end_date",
                    F.col("seq").alias("lifecycle_seq"), F.col("next_value").alias("next_start_date"),
                    F.coalesce(eff_end > F.col("next_value"), F.lit(False)).alias("overlaps_next"))


@query("doc_mrr_movement")
def doc_mrr_movement(spark, sf_dir):
    p = _p(spark, sf_dir)
    x = mrr_by_subscription(p)
    m = x.groupBy("customer_id", "revenue_month").agg(F.sum("monthly_price").cast("bigint").alias("mrr"))
    w = Window.partitionBy("customer_id").orderBy("revenue_month")
    prev_month = F.lag("revenue_month").over(w)
    prev = F.lag("mrr").over(w)
    m = m.select("customer_id", "revenue_month", "mrr", prev_month.alias("pm"), prev.alias("pv"))
    consecutive = F.col("pm") == F.add_months(F.col("revenue_month"), -1)
    prev_mrr = F.when(consecutive, F.col("pv"))
    movement = (F.when(prev_mrr.isNull(), "new").when(F.col("mrr") > prev_mrr, "expansion")
                .when(F.col("mrr") < prev_mrr, "contraction").otherwise("flat"))
    billed = m.select("customer_id", "revenue_month", "mrr", prev_mrr.alias("prev_mrr"), movement.alias("movement"))
    # The month after a billed one that is not billed, if it has begun, is a churned one.
    after = F.add_months("revenue_month", 1)
    following = F.lead("revenue_month").over(Window.partitionBy("customer_id").orderBy("revenue_month"))
    gone = billed.select("customer_id", after.alias("revenue_month"), F.lit(0).cast("bigint").alias("new_mrr"), "mrr",
                         (following.isNull() | (following > after)).alias("churned"))
    gone = gone.where(F.col("churned") & (F.col("revenue_month") <= run_date(p.config.as_of)))
    return billed.unionByName(gone.select("customer_id", "revenue_month", F.col("new_mrr").alias("mrr"),
                                          F.col("mrr").alias("prev_mrr"), F.lit("churned").alias("movement")))


@query("doc_refund_linkage")
def doc_refund_linkage(spark, sf_dir):
    p = _p(spark, sf_dir)
    ids = p.ref("silver_transactions").select("transaction_id").distinct().withColumn("is_linked", F.lit(True))
    r = p.ref("silver_refunds").select("refund_id", "transaction_id")
    return r.join(ids, "transaction_id", "left").select(
        "refund_id", "transaction_id", F.coalesce("is_linked", F.lit(False)).alias("is_linked"))


@query("doc_email_standardize")
def doc_email_standardize(spark, sf_dir):
    c = _p(spark, sf_dir).raw("customers")
    std = standardize_email("email")
    return c.select("customer_id", "email", std.alias("email_standardized"), F.md5(std).alias("email_std_hash"))


@query("doc_churn_classified")
def doc_churn_classified(spark, sf_dir):
    p = _p(spark, sf_dir)
    s = p.ref("silver_subscriptions")
    per_customer = s.groupBy("customer_id").agg(
        F.max(F.col("status") == "active").alias("has_active"),
        F.max(F.when(F.col("status") == "active", F.struct("start_date", "subscription_id", "plan_name")))
        .getField("plan_name").alias("last_active_plan"))
    c = canceled(p).select("subscription_id", "customer_id", F.col("end_date").alias("churn_date"))
    j = c.join(per_customer, "customer_id", "left")
    return j.select("churn_date", "subscription_id", "customer_id",
                    F.when(F.col("has_active"), "partial").otherwise("full").alias("churn_type"),
                    "last_active_plan")
