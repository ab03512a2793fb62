"""Gold layer: finance facts and metrics.

Scale notes
-----------
* Refund joins never carry raw refund rows through a join.  Where the
  reference joins transactions to *un-aggregated* refunds (so a transaction's
  amount is counted once per refund row), the same numbers come from refunds
  pre-aggregated per transaction (``count``, ``sum``) and
  ``amount * greatest(count, 1)``: the join is 1:1, partial aggregation
  absorbs a transaction holding most refunds, and the result is exact
  (decimal arithmetic).
* Sets used for membership (GO7) are distinct per key, so plain counts
  replace ``count(distinct)``; the paying and refunded flags come from one
  aggregation over the facts and the joins share one partitioning.
* The plan table is a fixed 3-row seed: it is broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finspark.config import ARR_PLAN_PRICES
from finspark.functions.dates import (day_of, last_series_month, month_boundaries_between, month_series, month_start,
                                      run_date)
from finspark.functions.numeric import safe_ratio
from finspark.operators.bronze import with_load_time
from finspark.plans.pipeline import Pipeline, model
from finspark.sources.seeds import subscription_plans


def refunds_per_transaction(p: Pipeline) -> DataFrame:
    return p.ref("refunds_per_transaction")


@model("refunds_per_transaction")
def refunds_by_transaction(p: Pipeline) -> DataFrame:
    """transaction_id, refund_rows, refund_sum (one row per transaction)."""
    return (p.ref("silver_refunds")
            .groupBy("transaction_id")
            .agg(F.count(F.lit(1)).alias("refund_rows"), F.sum("amount").alias("refund_sum")))


def success_transactions(p: Pipeline) -> DataFrame:
    return p.ref("silver_transactions").where(F.col("status") == "success")


def fanout_revenue(p: Pipeline, bucket) -> DataFrame:
    """Success transactions ⟕ refunds (1:N) summed per bucket, reproduced
    from per-transaction refund aggregates.  Returns bucket, gross, refunded."""
    t = success_transactions(p).select("transaction_id", bucket.alias("bucket"), "amount")
    j = t.join(refunds_per_transaction(p), "transaction_id", "left")
    mult = F.greatest(F.coalesce(F.col("refund_rows"), F.lit(1)), F.lit(1))
    return j.groupBy("bucket").agg(
        F.sum(F.col("amount") * mult).alias("gross"),
        F.coalesce(F.sum("refund_sum"), F.lit(0)).alias("refunded"),
    )


@model("gold_transaction_facts")
def gold_transaction_facts(p: Pipeline) -> DataFrame:
    t = p.ref("silver_transactions").select(
        "transaction_id", "customer_id", "account_id", F.col("amount").alias("transaction_amount"), "created_at")
    pay = p.ref("silver_payments").select("transaction_id", "final_payment_status")
    r = refunds_per_transaction(p).select("transaction_id", F.col("refund_sum").alias("total_refunded_amount"))
    j = t.join(pay, "transaction_id", "left").join(r, "transaction_id", "left")
    paid = F.coalesce(F.col("final_payment_status") == "success", F.lit(False))
    refunded = F.coalesce(F.col("total_refunded_amount"), F.lit(0))
    return with_load_time(j.select(
        "transaction_id", "customer_id", "account_id", "created_at", "transaction_amount",
        refunded.alias("refunded_amount"),
        F.when(paid, F.col("transaction_amount") - refunded).otherwise(F.lit(0)).alias("net_amount"),
        paid.alias("is_paid"),
    ), "gold_loaded_at")


@model("gold_daily_revenue")
def gold_daily_revenue(p: Pipeline) -> DataFrame:
    f = p.ref("gold_transaction_facts")
    out = f.groupBy(day_of("created_at").alias("revenue_date")).agg(
        F.sum("transaction_amount").alias("gross_transaction_amount"),
        F.sum("refunded_amount").alias("total_refunded_amount"),
        F.sum("net_amount").alias("net_revenue"),
        F.count(F.when(F.col("is_paid"), 1)).alias("paid_transaction_count"),
        F.count(F.when(~F.col("is_paid"), 1)).alias("unpaid_transaction_count"),
    )
    return with_load_time(out, "gold_loaded_at")


@model("gold_monthly_revenue")
def gold_monthly_revenue(p: Pipeline) -> DataFrame:
    m = fanout_revenue(p, month_start("created_at"))
    return m.select(
        F.col("bucket").alias("month"),
        F.col("gross").alias("gross_revenue"),
        (F.col("gross") - F.col("refunded")).alias("net_revenue"),
        F.col("refunded").alias("refund_amount"),
    )


def mrr_by_subscription(p: Pipeline, active_only: bool = True) -> DataFrame:
    """One row per subscription and month it is billed (the expanded set)."""
    s = p.ref("silver_subscriptions")
    if active_only:
        s = s.where(F.col("status") == "active")
    s = s.select("subscription_id", "customer_id", "plan_name", "status", "start_date",
                 F.coalesce("end_date", run_date(p.config.as_of)).alias("effective_end_date"))
    j = s.join(F.broadcast(subscription_plans(p.spark)), "plan_name")
    return j.select("subscription_id", "customer_id", "plan_name", "monthly_price", "status",
                    F.explode(month_series("start_date", "effective_end_date")).alias("revenue_month"))


def mrr_events(p: Pipeline) -> DataFrame:
    """(customer_id, month, price, n): what active subscriptions add in their first month and take
    away after their last; at most one row per customer and calendar month."""
    s = p.ref("silver_subscriptions").where((F.col("status") == "active") & F.col("start_date").isNotNull())
    end = F.coalesce("end_date", run_date(p.config.as_of))
    s = s.select("customer_id", "plan_name", month_start("start_date").alias("first"),
                 last_series_month("start_date", end).alias("last")).where(F.col("last").isNotNull())
    j = s.join(F.broadcast(subscription_plans(p.spark)), "plan_name")
    price = F.col("monthly_price").cast("bigint")
    begin = j.select("customer_id", F.col("first").alias("month"), price.alias("price"), F.lit(1).alias("n"))
    after = j.select("customer_id", F.add_months("last", 1).alias("month"), (-price).alias("price"), F.lit(-1).alias("n"))
    return begin.union(after).groupBy("customer_id", "month").agg(F.sum("price").alias("price"), F.sum("n").alias("n"))


@model("gold_mrr")
def gold_mrr(p: Pipeline) -> DataFrame:
    """A sweep over the months: subscriptions meet the shuffle as two events, however long they run.

    A customer counts while any subscription of theirs does: the running number of these per customer
    turns events into arrivals and departures.  One row per event month is then summed
    along the calendar, and months without events repeat the month before."""
    own = Window.partitionBy("customer_id").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    running = mrr_events(p).withColumn("now", F.sum("n").over(own)).withColumn("before", F.col("now") - F.col("n"))
    present = lambda c: F.when(F.col("customer_id").isNotNull() & (F.col(c) > 0), 1).otherwise(0)
    months = running.groupBy("month").agg(F.sum("price").alias("price"), F.sum("n").alias("n"),
                                          F.sum(present("now") - present("before")).alias("customers"))
    calendar = Window.orderBy("month")
    upto = calendar.rowsBetween(Window.unboundedPreceding, 0)
    steps = months.select("month", F.lead("month").over(calendar).alias("next"), F.sum("price").over(upto).alias("mrr"),
                          F.sum("n").over(upto).alias("n"), F.sum("customers").over(upto).alias("active_customers"))
    out = steps.where("n > 0").select(
        F.explode(F.sequence("month", F.add_months("next", -1), F.expr("interval 1 month"))).alias("revenue_month"),
        F.col("mrr").cast("bigint").alias("mrr"), F.col("active_customers").cast("bigint").alias("active_customers"))
    return with_load_time(out, "gold_loaded_at")


def arr_price(plan: str = "plan_name"):
    expr = None
    for name, price in ARR_PLAN_PRICES:
        expr = (F.when(F.col(plan) == name, price) if expr is None else expr.when(F.col(plan) == name, price))
    return expr.otherwise(0)


@model("gold_arr")
def gold_arr(p: Pipeline) -> DataFrame:
    s = p.ref("silver_subscriptions").where(F.col("status") == "active")
    return (s.groupBy(month_start("start_date").alias("month"))
            .agg((F.sum(arr_price()) * 12).cast("bigint").alias("arr")))


@model("gold_churn")
def gold_churn(p: Pipeline) -> DataFrame:
    s = p.ref("silver_subscriptions").where((F.col("status") == "canceled") & F.col("end_date").isNotNull())
    out = s.groupBy(month_start("end_date").alias("churn_month")).agg(
        F.count_distinct("customer_id").alias("churned_customers"))
    return with_load_time(out, "gold_loaded_at")


@model("gold_customer_metrics")
def gold_customer_metrics(p: Pipeline) -> DataFrame:
    """Active customers and, among them, paying / refunded / churned ones.

    Paying and refunded flags come from one aggregation over the facts (one
    scan, partial aggregation per customer); the three sets are distinct per
    customer, so counting joined rows equals the distinct counts."""
    def distinct_customers(df: DataFrame, flag: str) -> DataFrame:
        return (df.where(F.col("customer_id").isNotNull()).select("customer_id").distinct()
                .withColumn(flag, F.lit(True)))

    facts = (p.ref("gold_transaction_facts").where(F.col("customer_id").isNotNull())
             .groupBy("customer_id").agg(F.max("is_paid").alias("pa"),
                                         F.max(F.col("refunded_amount") > 0).alias("re")))
    active = distinct_customers(p.ref("silver_accounts").where(F.col("normalized_status") == "active"), "a")
    churned = distinct_customers(p.ref("silver_subscriptions").where(F.col("status") == "canceled"), "ch")
    j = active.join(facts, "customer_id", "left").join(churned, "customer_id", "left")
    out = j.agg(
        F.count(F.lit(1)).alias("active_customers"),
        F.count_if(F.col("pa")).alias("paying_customers"),
        F.count_if(F.col("re")).alias("refunded_customers"),
        F.count("ch").alias("churned_customers"),
    ).select(run_date(p.config.as_of).alias("snapshot_date"), "*")
    return with_load_time(out, "gold_loaded_at")


@model("gold_refund_rate")
def gold_refund_rate(p: Pipeline) -> DataFrame:
    d = fanout_revenue(p, day_of("created_at"))
    return d.select(
        F.col("bucket").alias("date"),
        F.col("gross").alias("paid_amount"),
        F.col("refunded").alias("refunded_amount"),
        safe_ratio("refunded", "gross").alias("refund_rate"),
    )


def payment_stats(p: Pipeline, bucket) -> DataFrame:
    pay = p.ref("silver_payments")
    return pay.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("attempt_count"),
        F.count_if(F.col("final_payment_status") != "success").alias("failed_count"),
    )


@model("gold_failed_payment_rate")
def gold_failed_payment_rate(p: Pipeline) -> DataFrame:
    d = payment_stats(p, day_of("attempted_at"))
    return d.select(F.col("bucket").alias("date"), "attempt_count", "failed_count",
                    safe_ratio("failed_count", "attempt_count").alias("failed_payment_rate"))


@model("gold_cohort_retention")
def gold_cohort_retention(p: Pipeline) -> DataFrame:
    """Cohort = month of a customer's first successful transaction.

    Distinct (customer, month) activity is computed once (partial aggregation
    absorbs hot customers); the cohort is the min month over the customer's
    own activity rows (a window over at most #months rows per customer), so
    no join back to a first-purchase table is needed.  Cohort size is the
    offset-0 count of the same cohort.
    """
    paid = success_transactions(p).where(F.col("customer_id").isNotNull())
    act = paid.select("customer_id", month_start("created_at").alias("activity_month")).distinct()
    act = act.withColumn("cohort_month", F.min("activity_month").over(Window.partitionBy("customer_id")))
    ca = act.groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("customers_retained"))
    ca = ca.withColumn("months_since_cohort", month_boundaries_between("cohort_month", "activity_month"))
    size = F.sum(F.when(F.col("months_since_cohort") == 0, F.col("customers_retained"))) \
        .over(Window.partitionBy("cohort_month"))
    out = ca.withColumn("customers_in_cohort", size)
    return out.where(F.col("months_since_cohort") >= 0).select(
        "cohort_month", "months_since_cohort", "customers_in_cohort", "customers_retained",
        safe_ratio("customers_retained", "customers_in_cohort").alias("retention_rate"),
    )
