"""Physical-plan assertions: the shapes the design relies on."""

from __future__ import annotations

from conftest import SF_SMALL
from finspark.plans.pipeline import Pipeline


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_before_the_shuffle(spark):
    txt = plan(Pipeline(spark, SF_SMALL).ref("silver_transactions"))
    assert "WindowGroupLimit" in txt and "Partial" in txt


def test_plan_seed_is_broadcast(spark):
    txt = plan(Pipeline(spark, SF_SMALL).ref("gold_mrr"))
    assert "BroadcastHashJoin" in txt


def test_mrr_shuffles_two_events_per_subscription_however_long(spark):
    """No month of a subscription is generated; only the calendar's gaps are, after all sums."""
    txt = plan(Pipeline(spark, SF_SMALL).ref("gold_mrr"))
    assert "last_day" not in txt and txt.index("Generate explode(sequence(month") < txt.index("HashAggregate")


def test_models_have_no_python_nodes(spark):
    p = Pipeline(spark, SF_SMALL)
    for m in ("gold_transaction_facts", "gold_mrr", "gold_cohort_retention",
              "platinum_anomalies_daily", "platinum_finance_exec_scorecard_monthly"):
        txt = plan(p.ref(m))
        assert "EvalPython" not in txt and "PythonUDF" not in txt, m


def test_refund_scan_pushes_filters_and_prunes_columns(spark):
    df = Pipeline(spark, SF_SMALL).raw("refunds")
    txt = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in txt
    assert "l_quantity" not in txt


def test_anomalies_scan_metrics_once(spark):
    """The long format comes from one Generate, not a 3-way union."""
    txt = plan(Pipeline(spark, SF_SMALL).ref("platinum_anomalies_daily"))
    assert "Generate" in txt and "Union" not in txt


def test_facts_joins_reuse_one_partitioning(spark):
    """Without broadcasts (as at scale): one shuffle per input on
    transaction_id, and the two joins add none."""
    import re
    old = (spark.conf.get("spark.sql.autoBroadcastJoinThreshold"),
           spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        txt = plan(Pipeline(spark, SF_SMALL).ref("gold_transaction_facts"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old[0])
        if old[1] is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old[1])
    assert len(re.findall(r"Exchange hashpartitioning\(transaction_id", txt)) == 3
    assert txt.count("SortMergeJoin") == 2


def test_small_upsert_batch_is_broadcast_against_the_target(spark):
    from finspark.operators.macros import upsert
    target = spark.range(1000).selectExpr("cast(id as string) as k", "id as v")
    batch = spark.createDataFrame([("5", 50), ("2000", 1)], "k string, v long")
    txt = plan(upsert(target, batch, "k"))
    assert "BroadcastHashJoin" in txt and "LeftAnti" in txt
    big = plan(upsert(target, batch, "k", broadcast_keys=1))
    assert "SortMergeJoin" in big or "ShuffledHashJoin" in big or "BroadcastHashJoin" in big
