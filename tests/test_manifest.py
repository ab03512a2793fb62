"""Manifest tables: what a merge rewrites, and what a crash leaves."""

import datetime as dt
import random
import uuid

import pytest
from finspark.operators.macros import upsert
from finspark.session import ensure_checkpoint_dir
from finspark.sources.manifest import ManifestTable
from py4j.protocol import Py4JJavaError

SCHEMA = "k string, ingestion_date date, v int"
DAY = dt.date(2024, 1, 1)


def table(spark, rows_per_file=100):
    return ManifestTable(spark, f"{ensure_checkpoint_dir(spark)}/manifest-{uuid.uuid4().hex}", "k", rows_per_file=rows_per_file)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def loaded(spark, n=4000, days=40):
    """Files by day; keys are spread over all of them."""
    rng = random.Random(2)
    keys = [f"{rng.getrandbits(60):015x}" for _ in range(n)]
    rows = [(k, DAY + dt.timedelta(days=i * days // n), 1) for i, k in enumerate(keys)]
    t = table(spark)
    t.append(frame(spark, rows))
    return t, rows


def content(df):
    return sorted(map(tuple, df.collect()), key=repr)


def paths(t, version=None):
    return {r["path"] for r in t.files(version).collect()}


def test_merge_rewrites_only_files_that_can_hold_a_key(spark):
    t, rows = loaded(spark)
    before = paths(t)
    assert len(before) >= 40
    # One percent of the keys, all of two days, and some new keys.
    batch = frame(spark, [(k, DAY + dt.timedelta(days=60), 2) for k, day, _ in rows if day in (DAY, DAY + dt.timedelta(days=1))][:40]
                  + [(f"new{i}", DAY + dt.timedelta(days=60), 2) for i in range(5)])
    holders = {r["path"] for r in t.read().selectExpr("k", "regexp_extract(_metadata.file_path, '(writes/.*)$', 1) as path")
               .join(batch, "k").select("path").distinct().collect()}
    expected = content(upsert(frame(spark, rows), batch, "k"))
    assert t.merge(batch) == 2
    rewritten = before - paths(t)
    assert holders <= rewritten and len(rewritten) <= len(holders) + 4  # a Bloom filter may admit a few more
    assert content(t.read()) == expected
    assert content(t.read(1)) == content(frame(spark, rows))  # the version before stays readable


def test_keys_outside_every_file_rewrite_nothing(spark):
    t, rows = loaded(spark, 400, 4)
    before = paths(t)
    t.merge(frame(spark, [("zz", DAY, 3), ("zz", DAY, 4), (None, DAY, 5)]))
    assert before < paths(t) and t.read().count() == 403
    t.merge(frame(spark, [(None, DAY, 6)]))  # a row without a key replaces nothing
    assert t.read().where("k is null").count() == 2


def test_a_crash_before_the_swap_leaves_the_version_before(spark, monkeypatch):
    t, rows = loaded(spark, 400, 4)
    batch = frame(spark, [(rows[0][0], DAY, 9)])
    with monkeypatch.context() as m:
        m.setattr(ManifestTable, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            t.merge(batch)
    assert t.version() == 1 and content(t.read()) == content(frame(spark, rows))
    t.merge(batch)
    assert t.version() == 2 and content(t.read()) == content(upsert(frame(spark, rows), batch, "k"))


def test_of_two_runs_for_one_version_the_second_fails(spark):
    t, rows = loaded(spark, 200, 2)
    t.merge(frame(spark, [("a", DAY, 1)]), 2)
    with pytest.raises(Py4JJavaError, match="FileAlreadyExists"):
        t.merge(frame(spark, [("b", DAY, 1)]), 2)
    assert t.read().where("k = 'a'").count() == 1 and t.read().where("k = 'b'").count() == 0


def test_marks_and_reads_use_the_manifest(spark):
    t, rows = loaded(spark)
    assert t.high_water_mark() == DAY + dt.timedelta(days=39)
    since = DAY + dt.timedelta(days=38)
    late = t.read(since=since)
    assert content(late) == content(frame(spark, [r for r in rows if r[1] >= since])) and len(late.inputFiles()) <= 4


def test_empty_tables_and_batches(spark):
    t = table(spark)
    assert t.version() == 0 and t.files().count() == 0 and t.high_water_mark() is None
    t.merge(frame(spark, []))
    assert t.version() == 1 and t.read().count() == 0 and t.read().schema.names == ["k", "ingestion_date", "v"]
    assert t.high_water_mark() is None
    t.merge(frame(spark, [("a", None, 1), ("b", DAY, 1)]))
    t.merge(frame(spark, []))
    assert t.version() == 3 and content(t.read()) == [("a", None, 1), ("b", DAY, 1)]
    t.merge(frame(spark, [("a", DAY, 2), ("b", DAY, 2)]))
    assert content(t.read()) == [("a", DAY, 2), ("b", DAY, 2)]
