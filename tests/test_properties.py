"""Property tests: month series, chunker, dedupe."""

from __future__ import annotations

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chunk_rules import check_chunks
from finspark.functions.dates import last_series_month, month_series
from finspark.operators.chunking import chunk_documents
from finspark.operators.macros import dedupe_latest, desc_last


def drifting_months(a: dt.date, b: dt.date) -> list[dt.date]:
    """Add one month repeatedly, clipping the day to the month's length."""
    out, cur = [], a
    while cur <= b:
        out.append(cur.replace(day=1))
        y, m = (cur.year + (cur.month == 12), cur.month % 12 + 1)
        cur = dt.date(y, m, min(cur.day, calendar.monthrange(y, m)[1]))
    return out


dates = st.dates(min_value=dt.date(1999, 1, 1), max_value=dt.date(2003, 12, 31))


@settings(max_examples=1, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(dates, dates), min_size=200, max_size=200))
def test_month_series_matches_drifting_series(spark, pairs):
    pairs += [(dt.date(2024, 1, 31), dt.date(2024, 3, 29)), (dt.date(2024, 1, 31), dt.date(2024, 3, 28)),
              (dt.date(2023, 5, 31), dt.date(2023, 5, 1)), (dt.date(2024, 2, 29), dt.date(2025, 2, 28))]
    pairs += [(dt.date(y, m, d), dt.date(y + (m + n - 1) // 12, (m + n - 1) % 12 + 1, e)) for y in (1999, 2000, 2004) for m in (1, 7, 8, 12)
              for d in (29, 30, 31) for n in (0, 1, 2, 3, 13) for e in (28, 1) if n or d <= e]
    df = spark.createDataFrame(pairs, "a date, b date")
    got = df.select("a", "b", month_series("a", "b").alias("m"), last_series_month("a", "b").alias("last")).collect()
    for a, b, m, last in got:
        months = drifting_months(a, b)
        assert list(m) == months and last == (months[-1] if months else None), (a, b)


line = st.one_of(st.text(alphabet="ab #\t", max_size=40), st.text(alphabet="xyz ", min_size=100, max_size=1200),
                 st.just("# Header"), st.just("## "))


def chunks_by_source(spark, texts, **options):
    df = spark.createDataFrame([(t, f"d{i}.md") for i, t in enumerate(texts)], "text string, source_file string")
    out = {f"d{i}.md": [] for i in range(len(texts))}
    for r in sorted(chunk_documents(df, **options).collect(), key=lambda r: r["chunk_index"]):
        assert r["chunk_id"] == f"{r['source_file']}:{r['chunk_index']}"
        out[r["source_file"]].append((r["text"], r["section"], r["start_line"], r["end_line"]))
    return list(out.values())


@settings(max_examples=1, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.lists(line, max_size=40), st.sampled_from(["\n", "\r\n", "\r"])),
                min_size=60, max_size=60))
def test_chunks_keep_the_rules(spark, docs):
    texts = [sep.join(x if x.strip() else "filled" for x in lines) + (sep if i % 2 and lines else "")
             for i, (lines, sep) in enumerate(docs)]
    for text, chunks in zip(texts, chunks_by_source(spark, texts, min_chars=0)):
        check_chunks(text, chunks)


def test_chunks_of_hand_made_texts(spark):
    full, short = "x" * 899, "y" * 100
    texts = [f"{full}\ntail {short}", f"{short}\n{short}\n\n{short}", "", "\n \n", f"{'z' * 600}\n# A\n{short}\n## \n{short}",
             f"{'a' * 700}\n{'b' * 60}\n{'c' * 200}\nend", "tiny", "# Only a heading " + short]
    got = chunks_by_source(spark, texts)
    assert [[(sec, s, e) for _, sec, s, e in c] for c in got] == [
        [("root", 1, 1), ("root", 1, 2)], [("root", 1, 4)], [], [], [("root", 1, 1), ("root", 2, 5)],
        [("root", 1, 3), ("root", 3, 4)], [], [("Only a heading " + short, 1, 1)]]
    assert got[1][0][0] == f"{short}\n{short}\n\n{short}"


def test_chunk_spans_cover_every_line(spark):
    text = "\n".join(f"line {i} " + "w" * (i * 37 % 300) for i in range(200))
    df = spark.createDataFrame([(text, "doc.md")], "text string, source_file string")
    spans = [(r["start_line"], r["end_line"]) for r in chunk_documents(df, min_chars=0).collect()]
    covered = set()
    for s, e in spans:
        covered |= set(range(s, e + 1))
    assert covered == set(range(1, 201))


def test_dedupe_is_idempotent(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c"), ("k", 2, "a")], "k string, v int, w string")
    once = dedupe_latest(df, "k", desc_last("v", "w"))
    twice = dedupe_latest(once, "k", desc_last("v", "w"))
    assert sorted(map(tuple, once.collect())) == [("j", 1, "c"), ("k", 2, "b")]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_ranked_with_next_splits_a_hot_group(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from finspark.operators.ordering import ranked_with_next
    rows = [("hot", i % 97, f"id{i:05d}") for i in range(3000)] + [(f"g{i}", i, f"x{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "g string, d int, id string")
    got = ranked_with_next(df, "g", ["d", "id"], "d", partitions=8)
    pieces = got.where("g = 'hot'").select(F.spark_partition_id()).distinct().count()
    w = Window.partitionBy("g").orderBy("d", "id")
    exp = df.select("*", F.row_number().over(w).alias("seq"), F.lead("d").over(w).alias("next_value"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))
    assert pieces >= 1
    hot_parts = (df.repartitionByRange(8, "g", "d", "id").where("g = 'hot'")
                 .select(F.spark_partition_id()).distinct().count())
    assert hot_parts > 1  # the hot group really is spread over several pieces


def test_documents_longer_than_one_block_keep_the_rules(spark):
    from finspark.operators.chunking import BLOCK_LINES
    texts = ["\n".join(("# H%d" % i) if i % 97 == 0 else ("w" * (1 + i * 53 % 700)) for i in range(3 * BLOCK_LINES + 17)),
             "\n".join("x" * 1000 for _ in range(BLOCK_LINES + 1)),
             "\n".join("y" for _ in range(2 * BLOCK_LINES))]
    for text, chunks in zip(texts, chunks_by_source(spark, texts, min_chars=0)):
        check_chunks(text, chunks)
