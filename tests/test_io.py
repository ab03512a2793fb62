"""Sources and sinks: markdown folders, multi-line CSV, catalog tables and
views, the batch job."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from decimal import Decimal

import pytest

from conftest import SF_SMALL
from finspark.operators.chunking import chunk_documents
from finspark.operators.retrieval import read_markdown_corpus
from finspark.plans.catalog import create_views, materialize
from finspark.plans.pipeline import Pipeline
from finspark.session import ensure_checkpoint_dir
from finspark.sources.files import read_entity_csv, write_entity_csv


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def test_markdown_folder_is_read_recursively(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.md").write_text("# Title\n" + "word " * 300, encoding="utf-8")
    (tmp_path / "two.md").write_text("# Other\n" + "text " * 50, encoding="utf-8")
    (tmp_path / "skip.txt").write_text("not markdown", encoding="utf-8")
    docs = read_markdown_corpus(spark, str(tmp_path))
    names = sorted(os.path.basename(r["source_file"]) for r in docs.collect())
    assert names == ["one.md", "two.md"]
    chunks = chunk_documents(docs).collect()
    assert {c["section"] for c in chunks} == {"Title", "Other"}


def test_csv_keeps_quoted_newlines_and_types(spark):
    rows = [("c1", "Ann", "a@x.io", "555", "1 Main St\nApt 2, \"rear\"", "d1", dt.datetime(2024, 1, 1, 5),
             dt.date(2024, 1, 2))]
    from finspark.sources.files import ENTITY_SCHEMAS
    df = spark.createDataFrame(rows, ENTITY_SCHEMAS["customers"])
    path = _scratch(spark, "csv")
    write_entity_csv(df, path)
    back = read_entity_csv(spark, path, "customers", multi_line=True).collect()
    assert [tuple(r) for r in back] == rows
    tx = spark.createDataFrame([("t1", "a", "c", Decimal("12.30"), "USD", "m", "success", dt.datetime(2024, 1, 1),
                                 None, dt.date(2024, 1, 1), "0042", "d")], ENTITY_SCHEMAS["transactions"])
    tpath = _scratch(spark, "csv-tx")
    write_entity_csv(tx, tpath)
    r = read_entity_csv(spark, tpath, "transactions", multi_line=True).first()
    assert r["amount"] == Decimal("12.30") and r["settled_at"] is None and r["card_last_four"] == "0042"


def test_materialize_tables_and_governance_views(spark):
    p = Pipeline(spark, SF_SMALL)
    written = materialize(spark, p, layers=("silver",))
    assert "silver.silver_customers" in written
    create_views(spark)
    cols = spark.table("analytics.analytics_customers").columns
    assert "address_hash" not in cols and "email_hash" in cols
    assert spark.table("admin.admin_customers").count() == p.ref("silver_customers").count()
    assert {t.name for t in spark.catalog.listTables("analytics")} >= {"analytics_payments", "analytics_accounts"}


def test_batch_job_writes_layers_and_reports(spark):
    from finspark.plans.run import build_all
    out = _scratch(spark, "run")
    written = build_all(spark, SF_SMALL, out, layers=("silver", "gold"))
    assert spark.read.parquet(written["gold_daily_revenue"]).count() > 0
    rep = spark.read.json(written["validation_report"]).first()
    assert rep["status"] in ("pass", "warn", "fail")
    # Later runs start from the written layers.
    again = Pipeline.from_materialized(spark, SF_SMALL, out, layers=("silver", "gold"))
    plan = again.ref("gold_monthly_revenue")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan  # no dedupe re-run: silver/gold come from parquet
    fresh = Pipeline(spark, SF_SMALL)
    got = sorted(map(tuple, again.ref("gold_daily_revenue").drop("gold_loaded_at").collect()))
    exp = sorted(map(tuple, fresh.ref("gold_daily_revenue").drop("gold_loaded_at").collect()))
    assert got == exp


def test_pipeline_from_raw_csv_files(spark):
    from finspark.sources.files import ENTITY_SCHEMAS
    fixtures = Pipeline(spark, SF_SMALL)
    root = _scratch(spark, "raw-csv")
    for e in ENTITY_SCHEMAS:
        write_entity_csv(fixtures.raw(e), f"{root}/{e}.csv")
    p = Pipeline.from_raw_csv(spark, root)
    for m in ("gold_daily_revenue", "gold_mrr", "platinum_finance_exec_scorecard_monthly"):
        a = sorted(map(tuple, p.ref(m).drop("gold_loaded_at").collect()))
        b = sorted(map(tuple, fixtures.ref(m).drop("gold_loaded_at").collect()))
        assert a == b, m


def test_pipeline_from_raw_json_and_parquet(spark):
    from finspark.sources.files import ENTITY_SCHEMAS
    fixtures = Pipeline(spark, SF_SMALL)
    exp = sorted(map(tuple, fixtures.ref("gold_transaction_facts").drop("gold_loaded_at").collect()))
    for fmt in ("json", "parquet"):
        root = _scratch(spark, f"raw-{fmt}")
        for e in ENTITY_SCHEMAS:
            fixtures.raw(e).write.mode("overwrite").format(fmt).save(f"{root}/{e}.{fmt}")
        p = Pipeline.from_raw_files(spark, root, fmt)
        got = sorted(map(tuple, p.ref("gold_transaction_facts").drop("gold_loaded_at").collect()))
        assert got == exp, fmt


def test_bad_lines_are_set_aside_whole_and_the_rest_loads(spark):
    from finspark.sources.files import TooManyBadRows, load_entity_csv
    good = ["r1,t1,10.50,duplicate_charge,2024-01-05,2024-01-06", 'r2,t1,,"a, b",,2024-01-06', ",,,,,"]
    bad = ["r3,t1,ten,duplicate_charge,2024-01-05,2024-01-06", "r4,t1", "r5,t1,1.00,x,2024-01-05,2024-01-06,more",
           "r6,t1,1.00,x,2024-13-05,2024-01-06"]
    header = "refund_id,transaction_id,amount,refund_reason,refunded_at,ingestion_date"
    path, aside = _scratch(spark, "bad-csv"), _scratch(spark, "aside")
    spark.createDataFrame([("\n".join([header, *good, *bad]),)], "line string").coalesce(1).write.text(path)
    rows, lines = load_entity_csv(spark, path, "refunds", aside, max_bad_share=0.6)
    assert sorted(rows.select("refund_id").collect(), key=repr) == sorted([("r1",), ("r2",), (None,)], key=repr)
    assert rows.where("amount = 10.50 and refunded_at = date'2024-01-05'").count() == 1 and rows.where("transaction_id = 't1'").count() == 2
    kept = lines.collect()
    assert sorted(r["line"] for r in kept) == sorted(bad) and {r["entity"] for r in kept} == {"refunds"}
    assert all(path.rsplit("/", 1)[1] in r["source_file"] for r in kept)
    with pytest.raises(TooManyBadRows, match="4 of 7 lines"):
        load_entity_csv(spark, path, "refunds", aside, max_bad_share=0.5)
    assert spark.read.parquet(aside).groupBy("is_bad").count().orderBy("is_bad").collect() == [("false", 3), ("true", 4)]
