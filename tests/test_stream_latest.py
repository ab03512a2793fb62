"""Latest row per key in bounded streaming state."""

from __future__ import annotations

import datetime as dt
import random
import uuid

from finspark.operators.macros import dedupe_latest, desc_last
from finspark.session import ensure_checkpoint_dir
from finspark.streaming.latest import read_latest, stream_latest

SCHEMA = "k string, day date, amount int, note string"
ORDER = ["day", "amount", "note"]
START = dt.date(2021, 1, 1)


def _land(spark, root, n, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(f"{root}/landing/drop-{n}")
    return stream_latest(spark, f"{root}/landing/drop-*", df.schema, root, "k", ORDER, "day", "30 days")


def _run(spark, drops):
    root = f"{ensure_checkpoint_dir(spark)}/latest-{uuid.uuid4().hex}"
    ended = [_land(spark, root, n, rows) for n, rows in enumerate(drops)]
    schema = spark.createDataFrame([], SCHEMA).schema
    return sorted(map(tuple, read_latest(spark, schema, root, "k", ORDER).collect()), key=str), ended


def _batch(spark, drops):
    rows = spark.createDataFrame([r for d in drops for r in d], SCHEMA)
    return sorted(map(tuple, dedupe_latest(rows, "k", desc_last(*ORDER)).collect()), key=str)


def test_late_and_repeated_rows_over_three_batches_equal_the_macro(spark):
    rng, drops = random.Random(2), [[], [], []]
    for i in range(400):
        day, late = rng.randrange(90), rng.randrange(20)
        row = (f"k{rng.randrange(60)}", START + dt.timedelta(day), rng.choice([None, *range(5)]), rng.choice([None, "a", "b"]))
        drops[min((day + late) // 30, 2)].append(row)
    drops[1] += drops[0][:40] + drops[1][:5]
    drops[2] += drops[1][:40] + [(None, START + dt.timedelta(80), 1, "x"), (None, START + dt.timedelta(81), 1, "x"),
                                 ("untimed", None, 3, "a"), ("untimed", None, 2, "b"), ("k1", None, 9, "z")]
    got, _ = _run(spark, drops)
    assert got == _batch(spark, drops)


def test_state_is_bounded_by_the_watermark_not_by_the_keys(spark):
    drops = [[(f"k{100 * n + i}", START + dt.timedelta(100 * n + i % 5), 1, "a") for i in range(100)] for n in range(4)]
    got, ended = _run(spark, drops)
    assert len(got) == 400 and got == _batch(spark, drops)
    kept = [max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) for q in ended]
    last = [q.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] for q in ended]
    assert max(kept) <= 200 and last[-1] <= 100


def test_rows_behind_the_watermark_are_given_up(spark):
    drops = [[("a", START + dt.timedelta(100), 1, "x")], [("a", START + dt.timedelta(101), 2, "y")],
             [("a", START, 5, "old"), ("b", START, 5, "old"), ("c", START + dt.timedelta(90), 1, "late")]]
    got, _ = _run(spark, drops)
    assert [r[0] for r in got] == ["a", "c"] and got[0][3] == "y"


def test_empty_landing(spark):
    assert _run(spark, [[]])[0] == []
