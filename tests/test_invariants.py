"""Cross-model invariants on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import SF_SMALL
from finspark.plans.pipeline import Pipeline


def test_daily_net_revenue_sums_to_facts(spark):
    p = Pipeline(spark, SF_SMALL)
    a = p.ref("gold_daily_revenue").agg(F.sum("net_revenue")).first()[0]
    b = p.ref("gold_transaction_facts").agg(F.sum("net_amount")).first()[0]
    assert a == b


def test_failed_never_exceeds_attempts(spark):
    g = Pipeline(spark, SF_SMALL).ref("gold_failed_payment_rate")
    assert g.where(F.col("failed_count") > F.col("attempt_count")).count() == 0


def test_offset_zero_retention_is_cohort_size(spark):
    c = Pipeline(spark, SF_SMALL).ref("gold_cohort_retention").where("months_since_cohort = 0")
    assert c.where(F.col("customers_retained") != F.col("customers_in_cohort")).count() == 0
    assert c.where(F.col("retention_rate") != 1.0).count() == 0


def test_silver_keys_unique(spark):
    p = Pipeline(spark, SF_SMALL)
    for m, k in (("silver_transactions", "transaction_id"), ("silver_payments", "transaction_id"),
                 ("silver_refunds", "refund_id"), ("silver_customers", "customer_id")):
        df = p.ref(m)
        assert df.count() == df.select(k).distinct().count(), m


def test_checkpointed_layers_give_the_same_results(spark):
    plain = Pipeline(spark, SF_SMALL)
    ck = Pipeline(spark, SF_SMALL, checkpoint=("silver_", "gold_transaction_facts"))
    for m in ("gold_daily_revenue", "gold_customer_metrics"):
        a = sorted(map(tuple, plain.ref(m).drop("gold_loaded_at").collect()))
        b = sorted(map(tuple, ck.ref(m).drop("gold_loaded_at").collect()))
        assert a == b, m
    assert "WindowGroupLimit" not in ck.ref("gold_daily_revenue")._jdf.queryExecution().executedPlan().toString()
