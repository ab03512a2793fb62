"""Relational primitives (projection, CASE, filters, joins, aggregates,
windows, sorting, scalar functions) as queries over the pipeline's tables.

Each query is the primitive at work on whole tables; the model modules use
the same building blocks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finspark.functions.dates import day_of, month_boundaries_between, month_series, month_start, run_date
from finspark.functions.masking import hash_normalized, hash_raw
from finspark.functions.numeric import safe_ratio
from finspark.operators.gold import arr_price, mrr_by_subscription, success_transactions
from finspark.operators.joins import fanout_left_join
from finspark.operators.macros import dedupe_latest, desc_last, incremental_filter
from finspark.operators.platinum import scorecard_daily_base
from finspark.operators.silver import DEDUPE_ORDER
from finspark.plans.pipeline import Pipeline, for_output
from finspark.plans.registry import pipeline, query, round_columns
from finspark.sources.seeds import subscription_plans
from finspark.sources.tables import read_table


def _p(spark: SparkSession, sf_dir: str) -> Pipeline:
    return pipeline(spark, sf_dir)


@query("p_projection")
def p_projection(spark, sf_dir) -> DataFrame:
    t = _p(spark, sf_dir).ref("silver_transactions")
    return for_output(t.select("transaction_id", "customer_id", "account_id",
                               F.col("amount").alias("transaction_amount"),
                               F.col("status").alias("transaction_status"), "created_at"))


@query("p_case")
def p_case(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    a = p.raw("accounts")
    status = (F.when(F.col("status") == "closed", "closed").when(F.col("status") == "suspended", "inactive")
              .otherwise("active"))
    return a.select("account_id", "status", status.alias("normalized_status"))


@query("p_filter_eq")
def p_filter_eq(spark, sf_dir) -> DataFrame:
    s = _p(spark, sf_dir).ref("silver_subscriptions")
    return s.where(F.col("status") == "active").select("subscription_id", "customer_id", "plan_name",
                                                       arr_price().alias("arr_monthly_price"))


@query("p_filter_range")
def p_filter_range(spark, sf_dir) -> DataFrame:
    f = _p(spark, sf_dir).ref("gold_transaction_facts")
    return for_output(f.where(F.col("refunded_amount") > 0)
                      .select("transaction_id", "customer_id", "refunded_amount"))


@query("p_union_all")
def p_union_all(spark, sf_dir) -> DataFrame:
    """A signed ledger: charges and refunds in one relation."""
    p = _p(spark, sf_dir)
    charges = success_transactions(p).select(
        "transaction_id", F.lit("charge").alias("entry_type"), day_of("created_at").alias("entry_date"),
        F.col("amount").cast("double").alias("amount"))
    refunds = p.ref("silver_refunds").select(
        "transaction_id", F.lit("refund").alias("entry_type"), F.col("refunded_at").alias("entry_date"),
        (-F.col("amount")).cast("double").alias("amount"))
    return charges.unionByName(refunds)


@query("join_inner_broadcast")
def join_inner_broadcast(spark, sf_dir) -> DataFrame:
    s = _p(spark, sf_dir).ref("silver_subscriptions")
    return s.join(F.broadcast(subscription_plans(spark)), "plan_name").select(
        "subscription_id", "plan_name", "monthly_price")


@query("join_left")
def join_left(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    t = p.ref("silver_transactions").select("transaction_id", "status")
    pay = p.ref("silver_payments").select("transaction_id", "payment_id", "final_payment_status")
    return t.join(pay, "transaction_id", "left")


@query("join_left_fanout")
def join_left_fanout(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    t = success_transactions(p).select("transaction_id", F.col("amount").cast("double").alias("amount"))
    r = p.ref("silver_refunds").select("transaction_id", "refund_id",
                                       F.col("amount").cast("double").alias("refund_amount"))
    return fanout_left_join(t, r, "transaction_id")


@query("join_lateral_series")
def join_lateral_series(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    return mrr_by_subscription(p, active_only=False).select("subscription_id", "status", "revenue_month")


@query("agg_sum")
def agg_sum(spark, sf_dir) -> DataFrame:
    t = _p(spark, sf_dir).ref("silver_transactions")
    return t.groupBy("customer_id").agg(F.sum("amount").cast("double").alias("total_amount"))


@query("agg_count")
def agg_count(spark, sf_dir) -> DataFrame:
    pay = _p(spark, sf_dir).ref("silver_payments")
    return pay.groupBy("payment_method").agg(F.count(F.lit(1)).alias("payment_count"))


@query("agg_count_filter")
def agg_count_filter(spark, sf_dir) -> DataFrame:
    pay = _p(spark, sf_dir).ref("bronze_payments")
    return pay.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("attempt_count"),
        F.count_if(F.col("status") != "success").alias("failed_count"))


@query("agg_count_case")
def agg_count_case(spark, sf_dir) -> DataFrame:
    f = _p(spark, sf_dir).ref("gold_transaction_facts")
    return f.groupBy("customer_id").agg(
        F.count(F.when(F.col("is_paid"), 1)).alias("paid_transaction_count"),
        F.count(F.when(~F.col("is_paid"), 1)).alias("unpaid_transaction_count"))


@query("agg_count_distinct")
def agg_count_distinct(spark, sf_dir) -> DataFrame:
    t = _p(spark, sf_dir).ref("silver_transactions")
    return t.groupBy("merchant_name").agg(
        F.count_distinct("customer_id").alias("distinct_customers"),
        F.count_distinct("account_id").alias("distinct_accounts"))


@query("agg_min")
def agg_min(spark, sf_dir) -> DataFrame:
    t = success_transactions(_p(spark, sf_dir))
    return t.groupBy("customer_id").agg(F.min("created_at").alias("first_paid_at"),
                                        F.min("amount").cast("double").alias("smallest_amount"))


@query("agg_max")
def agg_max(spark, sf_dir) -> DataFrame:
    """High-water marks: max(ingestion_date) per bronze table."""
    p = _p(spark, sf_dir)
    parts = [p.ref(f"bronze_{e}").agg(F.max("ingestion_date").alias("max_ingestion_date"))
             .select(F.lit(f"bronze_{e}").alias("table_name"), "max_ingestion_date")
             for e in ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("agg_distinct")
def agg_distinct(spark, sf_dir) -> DataFrame:
    a = _p(spark, sf_dir).ref("silver_accounts")
    return a.where(F.col("normalized_status") == "active").select("customer_id").distinct()


@query("dedupe_latest")
def dedupe_latest_q(spark, sf_dir) -> DataFrame:
    raw = _p(spark, sf_dir).raw("transactions")
    return for_output(dedupe_latest(raw, "transaction_id", desc_last(*DEDUPE_ORDER["transactions"]),
                                    keep_rank=True))


@query("win_moving_avg")
def win_moving_avg(spark, sf_dir) -> DataFrame:
    b = scorecard_daily_base(_p(spark, sf_dir))
    w = Window.orderBy("date").rowsBetween(-6, 0)
    out = b.select("date", F.col("net_revenue").cast("double").alias("net_revenue"),
                   F.avg("net_revenue").over(w).alias("net_revenue_7d_avg"))
    return round_columns(out, {"net_revenue_7d_avg": 4})


@query("win_lag")
def win_lag(spark, sf_dir) -> DataFrame:
    b = scorecard_daily_base(_p(spark, sf_dir))
    w = Window.orderBy("date")
    return for_output(b.select(
        "date", "net_revenue",
        F.lag("net_revenue", 1).over(w).alias("prev_day_net_revenue"),
        (F.col("net_revenue") - F.lag("net_revenue", 7).over(w)).alias("net_revenue_wow_change")))


def _trailing(spark, sf_dir, fn, name) -> DataFrame:
    b = scorecard_daily_base(_p(spark, sf_dir))
    w = Window.orderBy("date").rowsBetween(-30, -1)
    out = b.select("date", F.col("net_revenue").cast("double").alias("net_revenue"),
                   fn(F.col("net_revenue").cast("double")).over(w).alias(name))
    return round_columns(out, {name: 4})


@query("win_trailing_avg")
def win_trailing_avg(spark, sf_dir) -> DataFrame:
    return _trailing(spark, sf_dir, F.avg, "net_revenue_mean_30")


@query("win_trailing_stddev")
def win_trailing_stddev(spark, sf_dir) -> DataFrame:
    return _trailing(spark, sf_dir, F.stddev_samp, "net_revenue_std_30")


@query("sort_asc")
def sort_asc(spark, sf_dir) -> DataFrame:
    d = for_output(_p(spark, sf_dir).ref("gold_daily_revenue"))
    return d.select("revenue_date", "net_revenue").orderBy(F.col("revenue_date").asc_nulls_last())


@query("topk_latest")
def topk_latest(spark, sf_dir) -> DataFrame:
    """Latest two revenue days (ORDER BY ... DESC LIMIT 2 -> distributed top-k)."""
    d = for_output(_p(spark, sf_dir).ref("gold_daily_revenue"))
    return d.select("revenue_date", "net_revenue").orderBy(F.col("revenue_date").desc()).limit(2)


@query("fn_md5")
def fn_md5(spark, sf_dir) -> DataFrame:
    c = _p(spark, sf_dir).raw("customers")
    return c.select("customer_id", "email", hash_normalized("email").alias("email_hash"),
                    hash_raw("phone").alias("phone_hash"))


@query("fn_date")
def fn_date(spark, sf_dir) -> DataFrame:
    t = _p(spark, sf_dir).ref("silver_transactions")
    return t.select("transaction_id", "created_at", day_of("created_at").alias("created_date"))


@query("fn_month")
def fn_month(spark, sf_dir) -> DataFrame:
    t = _p(spark, sf_dir).ref("silver_transactions")
    return t.select("transaction_id", month_start("created_at").alias("month"),
                    month_start("settled_at").alias("settled_month"))


@query("fn_months_between")
def fn_months_between(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    a = p.ref("silver_accounts")
    end = F.coalesce("closed_at", run_date(p.config.as_of))
    return a.select("account_id", "opened_at", "closed_at",
                    month_boundaries_between("opened_at", end).alias("months_open"))


@query("fn_month_series")
def fn_month_series(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    s = p.ref("silver_subscriptions").select(
        "subscription_id", "start_date", F.coalesce("end_date", run_date(p.config.as_of)).alias("effective_end_date"))
    ms = month_series("start_date", "effective_end_date")
    return s.select("subscription_id", "start_date", "effective_end_date",
                    F.size(ms).cast("bigint").alias("months_billed"),
                    F.array_min(ms).alias("first_month"), F.array_max(ms).alias("last_month"))


@query("fn_coalesce")
def fn_coalesce(spark, sf_dir) -> DataFrame:
    p = _p(spark, sf_dir)
    s = p.ref("silver_subscriptions")
    return s.select("subscription_id", "end_date",
                    F.coalesce("end_date", run_date(p.config.as_of)).alias("effective_end_date"))


@query("fn_safe_ratio")
def fn_safe_ratio(spark, sf_dir) -> DataFrame:
    f = _p(spark, sf_dir).ref("gold_transaction_facts")
    t = _p(spark, sf_dir).ref("silver_transactions").select("transaction_id", "merchant_name")
    j = f.join(t, "transaction_id")
    g = j.groupBy("merchant_name").agg(
        F.sum(F.when(F.col("is_paid"), F.col("transaction_amount")).otherwise(0)).alias("paid_amount"),
        F.sum(F.when(F.col("is_paid"), F.col("refunded_amount")).otherwise(0)).alias("refunded_amount"),
        F.count(F.when(F.col("is_paid"), 1)).alias("paid_count"))
    out = g.select("merchant_name", "paid_count",
                   safe_ratio("refunded_amount", "paid_amount").alias("refund_rate"))
    return round_columns(out, {"refund_rate": 6})


# Events stand in for an incrementally loaded bronze table: the previous
# load holds events before this instant; the new batch is the whole table.
EVENTS_PREVIOUS_LOAD_BEFORE = "2024-01-16 00:00:00"


@query("incremental_filter")
def incremental_filter_q(spark, sf_dir) -> DataFrame:
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"]) \
        .withColumn("ingestion_date", F.to_date("ts"))
    target = ev.where(F.col("ts") < F.lit(EVENTS_PREVIOUS_LOAD_BEFORE).cast("timestamp_ntz"))
    return incremental_filter(ev, target, "ingestion_date")


@query("seed_subscription_plans")
def seed_subscription_plans(spark, sf_dir) -> DataFrame:
    s = _p(spark, sf_dir).ref("silver_subscriptions").groupBy("plan_name").agg(
        F.count(F.lit(1)).alias("subscriptions"))
    return subscription_plans(spark).join(s, "plan_name", "left").select(
        "plan_name", "monthly_price", F.coalesce("subscriptions", F.lit(0)).alias("subscriptions"))
