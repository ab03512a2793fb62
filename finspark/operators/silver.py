"""Silver layer: one row per entity key, PII masked.

Ordering ties on the reference's sort keys are broken deterministically by
the remaining business columns (descending, NULLs last) so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.functions.masking import hash_normalized, hash_raw
from finspark.operators.bronze import with_load_time
from finspark.operators.macros import dedupe_latest, desc_last
from finspark.plans.pipeline import Pipeline, model

# Sort keys per entity: the reference's keys first, then tie-breakers.
DEDUPE_ORDER = {
    "customers": ["ingestion_date", "full_name", "email", "phone", "address", "device_id", "created_at"],
    "accounts": ["ingestion_date", "customer_id", "account_type", "status", "opened_at", "closed_at"],
    "transactions": ["ingestion_date", "created_at", "amount", "status", "settled_at", "account_id",
                     "customer_id", "currency", "merchant_name", "card_last_four", "device_id"],
    "subscriptions": ["ingestion_date", "customer_id", "plan_name", "status", "start_date", "end_date"],
    "refunds": ["ingestion_date", "amount", "refund_reason", "refunded_at", "transaction_id"],
}


@model("silver_customers")
def silver_customers(p: Pipeline) -> DataFrame:
    d = dedupe_latest(p.ref("bronze_customers"), "customer_id", desc_last(*DEDUPE_ORDER["customers"]))
    return with_load_time(d.select(
        "customer_id",
        hash_normalized("full_name").alias("full_name_hash"),
        hash_normalized("email").alias("email_hash"),
        hash_raw("phone").alias("phone_hash"),
        hash_raw("address").alias("address_hash"),
        "device_id", "created_at", "ingestion_date",
    ), "silver_loaded_at")


@model("silver_accounts")
def silver_accounts(p: Pipeline) -> DataFrame:
    d = dedupe_latest(p.ref("bronze_accounts"), "account_id", desc_last(*DEDUPE_ORDER["accounts"]))
    status = (F.when(F.col("status") == "closed", "closed")
              .when(F.col("status") == "suspended", "inactive")
              .otherwise("active"))
    return with_load_time(d.select(
        "account_id", "customer_id", "account_type", status.alias("normalized_status"),
        "opened_at", "closed_at", "ingestion_date",
    ), "silver_loaded_at")


@model("silver_transactions")
def silver_transactions(p: Pipeline) -> DataFrame:
    d = dedupe_latest(p.ref("bronze_transactions"), "transaction_id",
                      desc_last(*DEDUPE_ORDER["transactions"]))
    return with_load_time(d.select(
        "transaction_id", "account_id", "customer_id", "amount", "currency", "merchant_name", "status",
        "created_at", "settled_at", "ingestion_date",
        hash_raw("card_last_four").alias("card_last_four_hash"),
        "device_id",
    ), "silver_loaded_at")


@model("silver_payments")
def silver_payments(p: Pipeline) -> DataFrame:
    """Final outcome per transaction: a success wins, else the latest attempt."""
    success_first = F.when(F.col("status") == "success", 1).otherwise(2)
    order = [success_first.asc(), *desc_last("attempted_at", "payment_id", "attempt_number",
                                             "ingestion_date", "payment_method")]
    d = dedupe_latest(p.ref("bronze_payments"), "transaction_id", order)
    return with_load_time(d.select(
        "payment_id", "transaction_id", "payment_method", F.col("status").alias("final_payment_status"),
        "attempt_number", "attempted_at", "ingestion_date",
    ), "silver_loaded_at")


@model("silver_subscriptions")
def silver_subscriptions(p: Pipeline) -> DataFrame:
    d = dedupe_latest(p.ref("bronze_subscriptions"), "subscription_id",
                      desc_last(*DEDUPE_ORDER["subscriptions"]))
    return with_load_time(d.select(
        "subscription_id", "customer_id", "plan_name", "status", "start_date", "end_date", "ingestion_date",
    ), "silver_loaded_at")


@model("silver_refunds")
def silver_refunds(p: Pipeline) -> DataFrame:
    d = dedupe_latest(p.ref("bronze_refunds"), "refund_id", desc_last(*DEDUPE_ORDER["refunds"]))
    return with_load_time(d.select(
        "refund_id", "transaction_id", "amount", "refund_reason", "refunded_at", "ingestion_date",
    ), "silver_loaded_at")
