import hashlib
import random

import brute
from finspark.llm import substring_dedup
from finspark.llm.substring_dedup import remove_repeats

SCHEMA = "doc_id bigint, text string"


def digest(rows):
    return sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows)


def test_cut_equals_brute_force(spark):
    rng = random.Random(3)
    shared = [brute.prose(rng, n) for n in (9, 12, 30)]
    rows = []
    for i in range(80):
        parts = [rng.choice(shared) if rng.random() < 0.5 else brute.prose(rng, rng.randrange(0, 25)) for _ in range(4)]
        text = "\n".join(parts)
        rows.append((i, brute.edited(rng, text, 1) if text.split() and rng.random() < 0.3 else text))
    rows += [(100, "a b " * 40), (101, "b a " * 40), (102, rows[3][1]), (103, rows[3][1])]
    rng.shuffle(rows)
    got = digest(remove_repeats(spark.createDataFrame(rows, SCHEMA), size=9, seed=4).collect())
    assert got == brute.cut_repeats(rows, 9)
    assert sum(r[2] for r in got) > 500


def test_runs_of_pieces_carry_a_phrase_over(spark):
    """All pieces of one phrase, worked off a few at a time, give the same spans."""
    import pyarrow as pa
    passage = [f"p{i}" for i in range(12)]
    text = " ".join(passage)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5] * 40), pa.array(range(40)), pa.array([1] * 40), pa.array([0] * 40), pa.array([3] * 40),
         pa.array([text.encode()] * 40)], ["gram", "id", "full", "at", "rel", "piece"])
    assert len(list(substring_dedup._gram_chunks([batch], 100))) >= 10
    out = pa.Table.from_batches(substring_dedup._span_rows(10, 4, most=100)([batch])).to_pylist()
    assert sorted((r["id"], r["begin"], r["end"]) for r in out) == [(i, 0, 12) for i in range(1, 40)]


def test_edge_rows(spark):
    long = " ".join(f"v{i}" for i in range(20_000))
    rows = [(1, None, "k"), (2, "", "k"), (3, long, "k"), (4, "start " + long, "k"), (5, "é x  y", "k"),
            (None, long, "k"), (3, long, "k")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string, spans string")).collect()
    by = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text[:5], r.spans, r.text) for r in got), key=str)
    assert [r[:4] for r in by] == [(1, 0, 0, ""), (2, 0, 0, ""), (3, 20_000, 0, "v0 v1"), (3, 20_000, 0, "v0 v1"),
                                   (4, 20_001, 20_000, "start"), (5, 2, 0, "é x y"), (None, 20_000, 0, "v0 v1")]
    assert {r[4] for r in by} == {"k"} and by[0][5] is None


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
