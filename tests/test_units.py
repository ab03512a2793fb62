"""Operator edge cases on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import D, T, pay, pipeline, refund, sub, txn
from finspark.config import PipelineConfig
from finspark.operators.compliance import pii_column_findings, pii_value_findings
from finspark.operators.insight import finance_insight
from finspark.operators.macros import incremental_filter, upsert
from finspark.plans.pipeline import for_output


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_null_account_status_is_active(spark):
    p = pipeline(spark, accounts=[("a1", "c1", "checking", None, D(2020, 1, 1), None, D(2020, 1, 1)),
                                  ("a2", "c1", "savings", "suspended", D(2020, 1, 1), None, D(2020, 1, 1))])
    got = dict(rows(p.ref("silver_accounts"), "account_id", "normalized_status"))
    assert got == {"a1": "active", "a2": "inactive"}


def test_latest_failed_attempt_wins_without_success(spark):
    p = pipeline(spark, payments=[pay("p1", "t1", "failed", 1, T(2024, 1, 1, 9)),
                                  pay("p2", "t1", "failed", 2, T(2024, 1, 1, 12)),
                                  pay("p3", "t2", "success", 1, T(2024, 1, 1, 9)),
                                  pay("p4", "t2", "failed", 2, T(2024, 1, 1, 12))])
    got = dict(rows(p.ref("silver_payments"), "transaction_id", "payment_id"))
    assert got == {"t1": "p2", "t2": "p3"}


def test_transaction_without_payment_is_unpaid(spark):
    p = pipeline(spark, transactions=[txn("t1")])
    r = for_output(p.ref("gold_transaction_facts")).first()
    assert r["is_paid"] is False and r["net_amount"] == 0.0 and r["refunded_amount"] == 0.0


def test_refund_fanout_reproduced_in_monthly_and_rate_not_in_facts(spark):
    p = pipeline(spark, transactions=[txn("t1", amount=100), txn("t2", amount=50)],
                 payments=[pay("p1", "t1", "success", 1, T(2024, 1, 1, 11))],
                 refunds=[refund("r1", "t1", 10), refund("r2", "t1", 20)])
    facts = dict(rows(for_output(p.ref("gold_transaction_facts")), "transaction_id", "refunded_amount"))
    assert facts == {"t1": 30.0, "t2": 0.0}
    m = for_output(p.ref("gold_monthly_revenue")).first()
    # t1 counted once per refund row (2x100) + t2 (50)
    assert (m["gross_revenue"], m["refund_amount"], m["net_revenue"]) == (250.0, 30.0, 220.0)
    rr = for_output(p.ref("gold_refund_rate")).first()
    assert rr["paid_amount"] == 250.0 and abs(rr["refund_rate"] - 30 / 250) < 1e-12


def test_zero_paid_amount_gives_null_rate(spark):
    p = pipeline(spark, transactions=[txn("t1", amount=0)])
    assert for_output(p.ref("gold_refund_rate")).first()["refund_rate"] is None


def test_month_series_from_31st_and_future_start(spark):
    cfg = PipelineConfig(as_of=D(2024, 5, 15))
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "basic", "active", D(2024, 1, 31), D(2024, 3, 30)),
                                       sub("s2", "c2", "pro", "active", D(2024, 6, 1))])
    p.config = cfg
    months = sorted(r["revenue_month"] for r in p.ref("gold_mrr").collect())
    # 31 Jan -> 29 Feb -> 29 Mar (<= 30 Mar): Jan, Feb, Mar; s2 starts after as_of: nothing
    assert months == [D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 1)]


def test_month_series_drops_last_month_when_day_drifts_past_end(spark):
    cfg = PipelineConfig(as_of=D(2030, 1, 1))
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "basic", "active", D(2024, 1, 31), D(2024, 3, 28))])
    p.config = cfg
    months = sorted(r["revenue_month"] for r in p.ref("gold_mrr").collect())
    assert months == [D(2024, 1, 1), D(2024, 2, 1)]


def test_mrr_counts_a_customer_once_over_overlaps_gaps_and_handovers(spark):
    p = pipeline(spark, subscriptions=[
        sub("s1", "c1", "basic", "active", D(2024, 1, 1), D(2024, 3, 15)), sub("s2", "c1", "pro", "active", D(2024, 2, 1), D(2024, 2, 20)),
        sub("s3", "c1", "basic", "active", D(2024, 4, 2), D(2024, 4, 9)), sub("s4", "c2", "basic", "active", D(2024, 8, 1), D(2024, 8, 1)),
        sub("s5", None, "basic", "active", D(2024, 8, 1), D(2024, 9, 1)), sub("s6", "c3", "basic", "active", D(2024, 5, 9), D(2024, 5, 1)),
        sub("s7", "c3", "basic", "active", None, D(2024, 5, 1)), sub("s8", "c3", "basic", "paused", D(2024, 5, 1), D(2024, 7, 1))])
    from finspark.operators.gold import mrr_by_subscription
    from pyspark.sql import functions as F
    plain = mrr_by_subscription(p).groupBy("revenue_month").agg(F.sum("monthly_price").cast("bigint").alias("mrr"),
                                                                F.count_distinct("customer_id").alias("active_customers"))
    got = sorted(rows(p.ref("gold_mrr"), "revenue_month", "mrr", "active_customers"))
    assert got == sorted(rows(plain, "revenue_month", "mrr", "active_customers"))
    assert [(m.month, n) for m, _, n in got] == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 1), (9, 0)]


def test_unknown_plan_dropped_by_mrr_priced_zero_by_arr(spark):
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "gold", "active", D(2024, 1, 1), D(2024, 1, 20))])
    assert p.ref("gold_mrr").count() == 0
    assert rows(p.ref("gold_arr"), "month", "arr") == [(D(2024, 1, 1), 0)]


def test_refund_only_day_absent_from_scorecard(spark):
    p = pipeline(spark, transactions=[txn("t1", created=T(2024, 1, 1, 10))],
                 refunds=[refund("r1", "t1", 5, at=D(2024, 1, 9))])
    dates = [r["date"] for r in p.ref("platinum_finance_exec_scorecard_daily").collect()]
    assert dates == [D(2024, 1, 1)]


def test_constant_metric_has_no_z_score(spark):
    txns = [txn(f"t{i}", amount=10, created=T(2024, 1, 1, 10) + dt.timedelta(days=i)) for i in range(31)]
    p = pipeline(spark, transactions=txns)
    a = p.ref("platinum_anomalies_daily").where(F.col("metric_name") == "net_revenue")
    reasons = {r["reason"] for r in a.collect()}
    assert reasons == {"insufficient_history"}


def test_empty_target_incremental_run_loads_nothing(spark):
    batch = spark.createDataFrame([(1, D(2024, 1, 1))], "id int, ingestion_date date")
    target = batch.limit(0)
    assert incremental_filter(batch, target, "ingestion_date").count() == 0
    assert incremental_filter(batch, None, "ingestion_date").count() == 1


def test_incremental_filter_rereads_boundary_day_and_drops_late_rows(spark):
    target = spark.createDataFrame([(1, D(2024, 1, 5))], "id int, ingestion_date date")
    batch = spark.createDataFrame([(2, D(2024, 1, 4)), (3, D(2024, 1, 5)), (4, D(2024, 1, 6))],
                                  "id int, ingestion_date date")
    assert sorted(r["id"] for r in incremental_filter(batch, target, "ingestion_date").collect()) == [3, 4]
    late = incremental_filter(batch, target, "ingestion_date", lookback_days=1)
    assert sorted(r["id"] for r in late.collect()) == [2, 3, 4]


def test_upsert_replaces_keys_and_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    batch = spark.createDataFrame([("b", 2), ("c", 2), ("c", 3)], "k string, v int")
    once = upsert(target, batch, "k")
    twice = upsert(once, batch, "k")
    assert sorted(map(tuple, once.collect())) == [("a", 1), ("b", 2), ("c", 2), ("c", 3)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_pii_findings(spark):
    p = pipeline(spark, customers=[("c1", "Ann Lee", "ann@example.com", "555-0100", "1 Main St", "d1",
                                    T(2024, 1, 1), D(2024, 1, 1))])
    cols = pii_column_findings(spark, p, layers=("bronze",)).collect()
    assert [(r["object"], r["severity"]) for r in cols] == [("bronze.bronze_customers", "fail")]
    t = spark.createDataFrame([("write to bob@mail.org or call +1 (555) 123-4567",)], "note string")
    p.override("gold_daily_revenue", t)
    from finspark.operators.compliance import value_scan
    r = value_scan("x", t).first()
    assert r["email_detected"] and r["phone_detected"]


def test_insight_fallbacks(spark):
    empty = finance_insight(pipeline(spark)).first()
    assert (empty["status"], empty["headline"]) == ("fail", "No daily revenue data found")
    one = finance_insight(pipeline(spark, transactions=[txn("t1")])).first()
    assert one["headline"] == "Net revenue reported, but prior day baseline missing"
    zero_prev = pipeline(spark, transactions=[txn("t1", created=T(2024, 1, 1, 10)),
                                              txn("t2", created=T(2024, 1, 2, 10))],
                         payments=[pay("p2", "t2", "success", 1, T(2024, 1, 2, 11))])
    r = finance_insight(zero_prev).first()
    assert r["headline"] == "Net revenue reported, but prior day baseline missing"
    assert r["status"] == "pass"


def test_insight_headline_and_refund_driver(spark):
    p = pipeline(spark, transactions=[txn("t1", amount=100, created=T(2024, 1, 1, 10)),
                                      txn("t2", amount=200, created=T(2024, 1, 2, 10))],
                 payments=[pay("p1", "t1", "success", 1, T(2024, 1, 1, 11)),
                           pay("p2", "t2", "success", 1, T(2024, 1, 2, 11))],
                 refunds=[refund("r1", "t2", 20)])
    r = finance_insight(p).first()
    assert r["headline"] == "Net revenue up 80.0% versus prior day"
    assert r["status"] == "warn" and r["drivers"] == "Refund pressure: Refund rate 10.00% is elevated"


def test_payment_retry_faults_match_row_order_definition(spark):
    """Gaps / repeats / out-of-order attempts, against a brute-force scan of
    each transaction's attempts in (attempt_number, payment_id) order."""
    from finspark.operators import triage
    attempts = [pay("p1", "t1", "failed", 1, T(2024, 1, 1, 9)), pay("p2", "t1", "failed", 3, T(2024, 1, 1, 8)),
                pay("p3", "t1", "success", 4, T(2024, 1, 1, 7)), pay("p4", "t2", "failed", 1, T(2024, 1, 1, 9)),
                pay("p5", "t2", "failed", 1, T(2024, 1, 1, 10)), pay("p6", "t2", "success", 2, T(2024, 1, 1, 9, 30)),
                pay("p7", "t3", "success", 2, T(2024, 1, 1, 9))]
    p = pipeline(spark, payments=attempts)
    from unittest import mock
    with mock.patch.object(triage, "_p", lambda s, d: p):
        got = {r["attempt_number"]: (r["attempts"], r["gap_rows"], r["out_of_order_rows"])
               for r in triage.triage_payment_retries(spark, "unused").collect()}
    exp: dict[int, list[int]] = {}
    by_txn: dict[str, list] = {}
    for a in attempts:
        by_txn.setdefault(a[1], []).append(a)
    for rows_ in by_txn.values():
        rows_.sort(key=lambda a: (a[4], a[0]))
        for i, a in enumerate(rows_):
            e = exp.setdefault(a[4], [0, 0, 0])
            e[0] += 1
            if i > 0 and a[4] - rows_[i - 1][4] != 1:
                e[1] += 1
            prev = [b[5] for b in rows_ if b[4] == a[4] - 1]
            if prev and a[5] < max(prev):
                e[2] += 1
    assert got == {k: tuple(v) for k, v in exp.items()}


def test_incremental_filter_lazy_matches_literal(spark):
    target = spark.createDataFrame([(1, D(2024, 1, 5)), (2, D(2024, 1, 3))], "id int, ingestion_date date")
    batch = spark.createDataFrame([(3, D(2024, 1, 4)), (4, D(2024, 1, 5)), (5, D(2024, 1, 7))],
                                  "id int, ingestion_date date")
    eager = sorted(r["id"] for r in incremental_filter(batch, target, "ingestion_date").collect())
    lazy = sorted(r["id"] for r in incremental_filter(batch, target, "ingestion_date", lazy=True).collect())
    assert eager == lazy == [4, 5]


def test_shuffle_partitions_sized_from_input(spark):
    from finspark.session import size_shuffle_partitions
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = size_shuffle_partitions(spark, ["/root/testdata/sf0.001/lineitem.parquet"], bytes_per_partition=1 << 10)
        assert n >= 100 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_checks_isolate_a_broken_table(spark):
    from finspark.operators.quality import freshness_checks, volume_checks
    p = pipeline(spark, transactions=[txn("t1", created=T(2024, 1, 1, 10)), txn("t2", created=T(2024, 1, 2, 10))])
    p.config = PipelineConfig(as_of=D(2024, 1, 4))
    tables = {"gold_transaction_facts": "created_at", "no_such_model": "created_at"}
    vol = {r["table_name"]: r["status"] for r in volume_checks(p, tables).collect()}
    fresh = {r["table_name"]: r["status"] for r in freshness_checks(p, tables).collect()}
    assert vol == {"gold_transaction_facts": "pass", "no_such_model": "error"}
    assert fresh == {"gold_transaction_facts": "pass", "no_such_model": "error"}


def test_encoder_hook_embeds_and_dense_search_finds_the_source(spark):
    from finspark.operators.retrieval import dense_topk, embed_with_encoder
    docs = spark.createDataFrame([(1, "monthly recurring revenue by plan"), (2, "refund rate per day"),
                                  (3, "cohort retention of customers")], "vec_id bigint, text string")
    vecs = embed_with_encoder(docs, "vec_id", "text")
    norms = [sum(x * x for x in r["embedding"]) for r in vecs.collect()]
    assert all(abs(n - 1) < 1e-5 for n in norms)
    q = embed_with_encoder(spark.createDataFrame([(7, "refund rate per day")], "query_id bigint, text string"),
                           "query_id", "text").withColumnRenamed("embedding", "qvec")
    top = dense_topk(vecs, q, 1).collect()
    assert [(r["query_id"], r["vec_id"]) for r in top] == [(7, 2)]


def test_bronze_append_mode_keeps_duplicates(spark):
    import uuid

    from finspark.operators.ingest import load_bronze
    from finspark.session import ensure_checkpoint_dir
    p = pipeline(spark, transactions=[txn("t1", ingested=D(2024, 1, 2)), txn("t2", ingested=D(2024, 1, 3))])
    raw = p.raw("transactions")
    up, ap = (f"{ensure_checkpoint_dir(spark)}/{m}-{uuid.uuid4().hex}" for m in ("up", "ap"))
    for table, mode in ((up, "upsert"), (ap, "append")):
        load_bronze(spark, raw, table, "transactions", mode=mode)
    assert load_bronze(spark, raw, up, "transactions").count() == 2          # t2 replaced by itself
    assert load_bronze(spark, raw, ap, "transactions", mode="append").count() == 3  # t2 kept twice


def test_dense_topk_batches_many_queries_like_brute_force(spark):
    import numpy as np

    from finspark.operators.retrieval import QUERY_BATCH, dense_topk
    rng = np.random.default_rng(7)
    vecs = rng.normal(size=(60, 8)).astype(np.float32)
    qs = rng.normal(size=(QUERY_BATCH + 40, 8))
    qs /= np.linalg.norm(qs, axis=1, keepdims=True)
    vdf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)],
                                "vec_id bigint, embedding array<float>")
    qdf = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(qs)], "query_id bigint, qvec array<double>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in dense_topk(vdf, qdf, 3).collect()}
    scores = np.round(qs @ vecs.astype(np.float64).T, 5)
    for qi in range(len(qs)):
        order = sorted(range(len(vecs)), key=lambda v: (-scores[qi, v], v))[:3]
        assert [got[(qi, r)] for r in (1, 2, 3)] == order


def test_checkpoint_dir_is_read_from_the_session(spark):
    from finspark.session import ensure_checkpoint_dir
    configured = spark.sparkContext.getCheckpointDir()
    assert configured and ensure_checkpoint_dir(spark) == configured


def test_no_shared_folder_is_an_error_on_a_cluster():
    from types import SimpleNamespace

    from finspark.session import ensure_checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context, conf={}))


def test_pii_scan_sees_every_row_and_a_sample_does_not(spark):
    from finspark.operators.compliance import value_scan
    rows = [(f"note {i:04d}",) for i in range(300)] + [("zz reach me at someone@example.org",)]
    df = spark.createDataFrame(rows, "note string")
    assert value_scan("t", df).first()["email_detected"] is True
    assert value_scan("t", df, sample=True).first()["email_detected"] is False      # sorted sample: first 200 only


def test_pii_scan_reads_all_string_columns(spark):
    from finspark.operators.compliance import value_scan
    df = spark.createDataFrame([("a", "b", "c", "d", "e", "f", "write to bob@mail.org")], "c1 string, c2 string, "
                               "c3 string, c4 string, c5 string, c6 string, c7 string")
    assert value_scan("t", df).first()["email_detected"] is True


def test_unreadable_table_is_a_scan_error_finding(spark):
    from finspark.operators.compliance import compliance_status
    from finspark.plans.pipeline import Pipeline
    p = Pipeline(spark, "/nonexistent", overrides={f"raw_{e}": pipeline(spark).raw(e) for e in (
        "customers", "accounts", "payments", "subscriptions", "refunds")})
    rows = {r["object"]: r for r in pii_value_findings(spark, p, layers=("bronze",)).collect()}
    bad = rows["bronze.bronze_transactions"]
    assert bad["finding"] and "/nonexistent" in bad["scan_error"]
    assert [o for o, r in rows.items() if r["scan_error"]] == ["bronze.bronze_transactions"]
    assert compliance_status(spark, p, layers=("bronze",)).first()["status"] == "fail"  # the customers' columns


def test_default_run_date_is_today(spark):
    start = D.today().replace(day=1)
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "basic", "active", D(2024, 1, 1)),
                                       sub("s2", "c2", "pro", "active", start)])
    assert p.config.as_of is None
    months = {r["revenue_month"] for r in p.ref("gold_mrr").collect()}
    assert D(2024, 1, 1) in months and start in months
