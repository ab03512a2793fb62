"""Structured Streaming ingest: exactly-once versions, batch equivalence."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from finspark.operators.macros import upsert
from finspark.plans.pipeline import Pipeline
from finspark.session import ensure_checkpoint_dir
from finspark.sources.files import ENTITY_SCHEMAS
from finspark.sources.manifest import ManifestTable
from finspark.streaming.ingest import _merge_batch, stream_bronze_demo, stream_event_counts


def _root(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _cols(df):
    return df.select(*ENTITY_SCHEMAS["transactions"].fieldNames())


def test_replayed_batch_rewrites_the_same_version(spark):
    raw = Pipeline(spark, SF_SMALL).raw("transactions")
    table = _root(spark, "bronze")
    merge = _merge_batch(spark, table, "transactions", 0)
    first, second = raw.where("ingestion_date < date'1998-01-01'"), raw.where("ingestion_date >= date'1998-01-01'")
    merge(first, 0)
    merge(second, 1)
    v2 = sorted(map(tuple, _cols(ManifestTable(spark, table, "transaction_id").read(2)).collect()))
    merge(second, 1)  # replay after a failure
    again = sorted(map(tuple, _cols(ManifestTable(spark, table, "transaction_id").read(2)).collect()))
    assert v2 == again
    assert v2 == sorted(map(tuple, _cols(upsert(first, second, "transaction_id")).collect()))


def test_stream_goes_on_from_a_loaded_table_and_a_lost_version_is_an_error(spark):
    from finspark.operators.ingest import load_bronze
    from finspark.streaming.ingest import _base_version
    raw = Pipeline(spark, SF_SMALL).raw("transactions")
    table, checkpoint = _root(spark, "bronze"), _root(spark, "progress")
    first, second = raw.where("ingestion_date < date'1998-01-01'"), raw.where("ingestion_date >= date'1998-01-01'")
    load_bronze(spark, first, table, "transactions")
    base = _base_version(spark, table, checkpoint)
    _merge_batch(spark, table, "transactions", base)(second, 0)
    assert _base_version(spark, table, checkpoint) == base == 1
    got = _cols(ManifestTable(spark, table, "transaction_id").read(2))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _cols(upsert(first, second, "transaction_id")).collect()))
    with pytest.raises(RuntimeError, match="version 7"):
        _merge_batch(spark, table, "transactions", base)(second, 6)


def test_two_landings_equal_batch_upsert(spark):
    raw = Pipeline(spark, SF_SMALL).raw("transactions")
    got = _cols(stream_bronze_demo(spark, raw, "transactions", _root(spark, "demo")))
    first = raw.where("ingestion_date < date'1998-01-01'")
    second = raw.where("ingestion_date >= date'1998-01-01'")
    exp = upsert(first, second, "transaction_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, _cols(exp).collect()))


def test_watermarked_counts_equal_batch_counts(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    got = stream_event_counts(spark, ev, _root(spark, "events"))
    exp = ev.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("events"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
