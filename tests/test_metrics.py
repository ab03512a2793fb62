"""Checks of a finished run read what was measured while its layers were written."""

import uuid

from conftest import SF_SMALL
from finspark.operators.quality import (MONITORED_DATE_COLUMNS, accepted_values_checks, freshness_checks, not_null_checks, schema_tests,
                                        unique_checks, validation_status, volume_checks)
from finspark.plans.metrics import read_metrics, use_metrics, write_measured
from finspark.plans.pipeline import Pipeline
from finspark.plans.run import build_all
from finspark.session import ensure_checkpoint_dir
from fixtures import D, pipeline, sub

LAYERS = ("bronze", "silver", "gold", "platinum")


def content(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def test_a_finished_run_is_validated_without_scanning_a_model(spark):
    out = f"{ensure_checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    build_all(spark, SF_SMALL, out, layers=LAYERS)
    plain, done = Pipeline(spark, SF_SMALL), Pipeline.from_materialized(spark, SF_SMALL, out, layers=LAYERS)
    assert set(MONITORED_DATE_COLUMNS) <= done.measured and len(done.measured) > 20
    for check in (not_null_checks, unique_checks, accepted_values_checks, volume_checks, freshness_checks, validation_status):
        got = check(done)
        read = got.inputFiles()
        assert read and all("/metrics/" in f for f in read), check.__name__
        assert content(got) == content(check(plain)), check.__name__


def test_measurements_are_those_of_the_rows_written(spark):
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "basic", "active", D(2024, 1, 1)), sub("s1", "c1", "vip", "gone", D(2024, 1, 1)),
                                       sub(None, "c1", "basic", "active", D(2024, 1, 1), ingested=None)])
    root = f"{ensure_checkpoint_dir(spark)}/measured-{uuid.uuid4().hex}"
    write_measured(p, "bronze_subscriptions", f"{root}/bronze_subscriptions", f"{root}/metrics")
    got = {(r["metric"], r["column_name"]): r["value"] for r in read_metrics(spark, f"{root}/metrics").collect()}
    assert got == {("rows", None): 3, ("nulls", "ingestion_date"): 1, ("nulls", "subscription_id"): 1, ("invalid", "plan_name"): 1,
                   ("invalid", "status"): 1, ("repeated", "subscription_id"): 1}


def test_models_without_measurements_are_still_checked(spark):
    p = pipeline(spark, subscriptions=[sub("s1", "c1", "basic", "active", D(2024, 1, 1))])
    expected = content(schema_tests(p))
    root = f"{ensure_checkpoint_dir(spark)}/measured-{uuid.uuid4().hex}"
    write_measured(p, "gold_arr", f"{root}/gold_arr", f"{root}/metrics")
    assert content(schema_tests(use_metrics(p, f"{root}/metrics"))) == expected and p.measured == {"gold_arr"}
    assert use_metrics(pipeline(spark), f"{root}/nothing").measured == set()
