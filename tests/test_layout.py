"""Bucketed layers: joins without a shuffle, the same rows, any session can open them."""

from __future__ import annotations

import uuid

import pytest

from conftest import SF_SMALL
from finspark.operators.docmetrics import final_statuses
from finspark.plans.layout import FACTS, KEY, SOURCES, open_layout, write_layout
from finspark.plans.pipeline import MODELS, Pipeline, for_output
from finspark.session import ensure_checkpoint_dir


def _out(spark):
    return f"{ensure_checkpoint_dir(spark)}/layout-{uuid.uuid4().hex}"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_need_no_shuffle_and_give_the_same_rows(spark):
    plain, out = Pipeline(spark, SF_SMALL), _out(spark)
    laid = write_layout(plain, out, 6)
    again = open_layout(spark, SF_SMALL, out)
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for p in (laid, again):
            for df, joins in ((for_output(MODELS[FACTS](p)), 2), (final_statuses(p), 1)):
                plan = _plan(df)
                assert "Exchange" not in plan and plan.count("SortMergeJoin") + plan.count("ShuffledHashJoin") == joins
                assert "SelectedBucketsCount: 6 out of 6" in plan
        assert "Exchange hashpartitioning" in _plan(final_statuses(plain))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert _rows(final_statuses(again)) == _rows(final_statuses(plain))
    assert _rows(for_output(again.ref(FACTS))) == _rows(for_output(plain.ref(FACTS)))


def test_one_file_a_bucket_and_opening_from_files_alone(spark):
    plain, out = Pipeline(spark, SF_SMALL), _out(spark)
    laid = write_layout(plain, out, 4)
    for name in (*SOURCES, FACTS):
        assert len(spark.read.parquet(f"{out}/{name}").inputFiles()) <= 4
    want = _rows(final_statuses(laid))
    for name in (*SOURCES, FACTS):  # a new session has no tables, only the folder
        spark.sql(f"drop table {laid.ref(name)._jdf.queryExecution().analyzed().collectLeaves().head().catalogTable().get().identifier().table()}")
    assert _rows(final_statuses(open_layout(spark, SF_SMALL, out))) == want


def test_a_folder_without_a_finished_layout_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        open_layout(spark, SF_SMALL, _out(spark))


def test_empty_tables_and_null_keys(spark):
    plain = Pipeline(spark, SF_SMALL)
    empty = Pipeline(spark, SF_SMALL, overrides={n: spark.createDataFrame([], plain.ref(n).schema) for n in SOURCES})
    assert final_statuses(write_layout(empty, _out(spark), 3)).collect() == []
    t = plain.ref("silver_transactions").limit(3)
    nulls = t.withColumn(KEY, t[KEY].substr(1, 0)).limit(1).selectExpr(f"nullif({KEY}, '') as {KEY}", *[c for c in t.columns if c != KEY])
    p = Pipeline(spark, SF_SMALL, overrides={n: plain.ref(n) for n in SOURCES[1:]} | {"silver_transactions": t.unionByName(nulls)})
    laid = write_layout(p, _out(spark), 3)
    assert laid.ref(FACTS).where(f"{KEY} is null").count() == 1 and laid.ref(FACTS).count() == 4
