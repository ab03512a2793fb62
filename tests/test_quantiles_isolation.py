"""Exact quantiles by counting passes, and checks that fail alone."""

import random
import uuid

import duckdb
import pandas as pd
from conftest import SF_SMALL
from finspark.functions.quantiles import quantiles
from finspark.operators.compliance import isolated_value_findings, pii_value_findings
from finspark.operators.quality import isolated_volume_checks, volume_checks, with_cut_file
from finspark.plans.pipeline import Pipeline
from finspark.session import ensure_checkpoint_dir


def test_quantiles_equal_duckdb(spark):
    rng = random.Random(4)
    rows = [("a", rng.randrange(-10 ** 12, 10 ** 12)) for _ in range(997)] + [("b", 7)] * 500 + [("b", 9)] * 3
    rows += [("c", i * i) for i in range(100)] + [("d", 5), (None, 3), (None, 8), ("e", None)]
    ps = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "p95": 0.95, "highest": 1.0}
    for bins in (4, 1024):
        df = spark.createDataFrame(rows, "g string, v bigint")
        got = sorted(map(tuple, quantiles(df, "g", "v", ps, cut=lambda x: x.checkpoint(), bins=bins).collect()), key=repr)
        con = duckdb.connect()
        con.register("t", pd.DataFrame([r for r in rows if r[1] is not None], columns=["g", "v"]).astype({"v": "int64"}))
        expected = con.execute("select g, " + ", ".join(f"quantile_cont(v::double, {p}) as {n}" for n, p in ps.items()) + " from t group by g").fetchall()
        assert [r[0] for r in got] == [r[0] for r in sorted(expected, key=repr)]
        for a, b in zip(got, sorted(expected, key=repr)):
            assert all(abs(x - y) <= 1e-9 * max(1, abs(y)) for x, y in zip(a[1:], b[1:])), (a, b)
    assert quantiles(df.limit(0), "g", "v", ps).count() == 0


def test_no_group_buffers_its_values(spark):
    df = spark.range(1000).selectExpr("id % 3 as g", "id as v")
    plan = quantiles(df, "g", "v", {"m": 0.5}, cut=lambda x: x.checkpoint())._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_list" not in plan and "ObjectHashAggregate" not in plan


def damaged(spark, model):
    """A pipeline whose ``model`` is a file cut short."""
    return with_cut_file(Pipeline(spark, SF_SMALL), model, f"{ensure_checkpoint_dir(spark)}/damaged-{uuid.uuid4().hex}")


def test_a_file_cut_short_is_one_error_row(spark):
    p, whole = damaged(spark, "gold_churn"), Pipeline(spark, SF_SMALL)
    got = {r["table_name"]: r for r in isolated_volume_checks(p).collect()}
    plain = {r["table_name"]: r for r in volume_checks(whole).collect()}
    assert got["gold_churn"]["status"] == "error" and "parquet" in got["gold_churn"]["reason"].lower()
    assert {t: r for t, r in got.items() if t != "gold_churn"} == {t: r for t, r in plain.items() if t != "gold_churn"}


def test_a_file_cut_short_is_one_scan_error(spark):
    layers = ("silver",)
    got = {r["object"]: r for r in isolated_value_findings(spark, damaged(spark, "silver_transactions"), layers).collect()}
    plain = {r["object"]: r for r in pii_value_findings(spark, Pipeline(spark, SF_SMALL), layers).collect()}
    bad = got.pop("silver.silver_transactions")
    assert bad["finding"] and "parquet" in bad["scan_error"].lower() and bad["email_detected"] is None
    plain.pop("silver.silver_transactions")
    assert got and {o: tuple(r) for o, r in got.items()} == {o: tuple(r) for o, r in plain.items()}
