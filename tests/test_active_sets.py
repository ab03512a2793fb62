"""Mergeable distinct customers: merged loads equal a recount, failed loads leave nothing behind."""

from __future__ import annotations

import datetime as dt
import random
import uuid
from collections import defaultdict

import pytest

from finspark.operators.active_sets import ActiveSets
from finspark.session import ensure_checkpoint_dir

SCHEMA = "customer_id string, created_at timestamp_ntz, amount int"


def _store(spark):
    return ActiveSets(spark, f"{ensure_checkpoint_dir(spark)}/sets-{uuid.uuid4().hex}")


def _facts(rng, n=600):
    rows = [(str(rng.randrange(80)), dt.datetime(2020, rng.randrange(1, 13), rng.randrange(1, 28)), i) for i in range(n)]
    return rows + [(None, dt.datetime(2020, 3, 1), 0), ("7", None, 0), ("", dt.datetime(2020, 5, 9), 1), rows[0], rows[0]]


def _by_hand(rows):
    months = defaultdict(set)
    for customer, at, _ in rows:
        if customer is not None and at is not None:
            months[customer].add(dt.date(at.year, at.month, 1))
    pairs = [(min(own), m, c) for c, own in months.items() for m in own]
    counts = defaultdict(int)
    for cohort, month, _ in pairs:
        counts[cohort, month.month - cohort.month] += 1
    trailing = {m: len({c for _, a, c in pairs if 0 <= (m.month - a.month) < 3}) for _, m, _ in pairs}
    return dict(counts), trailing


def _retention(store):
    return {(r.cohort_month, r.months_since_cohort): r.customers_retained for r in store.retention().collect()}


def test_a_month_merges_from_its_own_facts_alone(spark):
    rows = _facts(random.Random(3))
    store, march = _store(spark), dt.datetime(2020, 3, 1)
    early = [r for r in rows if r[1] is None or r[1] < march]
    store.add(spark.createDataFrame(early, SCHEMA), None, dt.date(2020, 3, 1))
    for m in range(3, 12):  # every call gets the facts of its month and nothing else
        own = [r for r in rows if r[1] and r[1].month == m]
        store.add(spark.createDataFrame(own, SCHEMA), dt.date(2020, m, 1), dt.date(2020, m + 1, 1))
    store.add(spark.createDataFrame(rows, SCHEMA), dt.date(2020, 12, 1), None)  # given all, it takes its month
    counts, trailing = _by_hand(rows)
    assert _retention(store) == counts
    assert {r.span: r.active_customers for r in store.distinct_trailing(3).collect()} == trailing
    numbers = sorted(r.number for r in store.customers().collect())
    assert numbers == list(range(1, len({r[0] for r in rows if r[0] is not None and r[1]}) + 1))


def test_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(_facts(random.Random(4), 50), SCHEMA).write.parquet(str(tmp_path / "facts"))
    seen = []
    store = _store(spark)
    store._stored = lambda path, df, keep=store._stored: (seen.append(df), keep(path, df))[1]
    store.add(spark.read.parquet(str(tmp_path / "facts")), dt.date(2020, 4, 1), dt.date(2020, 5, 1))
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_at" in plan and "LessThan(created_at" in plan and "amount" not in plan


def test_an_unfinished_load_did_not_happen(spark):
    rows = _facts(random.Random(5), 200)
    store = _store(spark)
    facts = spark.createDataFrame(rows, SCHEMA)
    store.add(facts, None, dt.date(2020, 6, 1))
    before = _retention(store)
    spark.createDataFrame([("x", 99, dt.date(2020, 6, 1))], "customer_id string, number bigint, cohort_month date").write.parquet(
        f"{store.root}/load=1/customers")  # died before its sets
    assert store.loads() == 1 and _retention(store) == before
    store.add(facts, dt.date(2020, 6, 1), None)
    assert _retention(store) == _by_hand(rows)[0]


def test_earlier_months_and_broken_bounds_are_errors(spark):
    store = _store(spark)
    facts = spark.createDataFrame([("1", dt.datetime(2020, 5, 5), 1)], SCHEMA)
    store.add(facts, None, None)
    for since in (None, dt.date(2020, 5, 1), dt.date(2019, 1, 1)):
        with pytest.raises(ValueError):
            store.add(facts, since, None)
    with pytest.raises(ValueError):
        store.add(facts, dt.date(2020, 6, 2), None)


def test_empty_loads(spark):
    store = _store(spark)
    assert store.retention().collect() == [] and store.loads() == 0
    store.add(spark.createDataFrame([], SCHEMA), None, None)
    assert store.loads() == 1 and store.retention().collect() == [] and store.distinct_trailing(12).collect() == []
    store.add(spark.createDataFrame([("1", dt.datetime(2020, 5, 5), 1)], SCHEMA), None, None)
    assert _retention(store) == {(dt.date(2020, 5, 1), 0): 1}
