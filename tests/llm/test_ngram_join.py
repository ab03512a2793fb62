import random

import brute
from finspark.llm.ngram_join import jaccard_components

SCHEMA = "doc_id bigint, text string"


def run(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, schema)).collect()),
                  key=lambda r: tuple((x is None, x) for x in r))


def test_components_equal_brute_force(spark):
    rng = random.Random(5)
    bases = [brute.prose(rng, n) for n in (6, 40, 60, 120)]
    rows = [(i, brute.edited(rng, rng.choice(bases), rng.choice((0, 0, 1, 1, 2, 4)))) for i in range(60)]
    rows += [(100 + i, brute.prose(rng, rng.randrange(1, 30))) for i in range(20)]
    rows += [(200 + i, " ".join(bases[2].split()[i:] + [f"tail{i}"] * i)) for i in range(12)]  # a chain of neighbours
    rng.shuffle(rows)
    expected = brute.jaccard_components(rows)
    assert run(spark, rows) == expected
    assert len({c for _, _, c in expected}) < len(rows) - 30


def test_edge_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(1, None, 7, "a"), (2, "", 7, "a"), (3, " \t\n", 7, "a"), (4, "two words", 7, "a"), (5, "Two  WORDS", 7, "a"),
            (6, long, 7, "a"), (7, long + " end", 7, "a"), (8, "ÄB c d e f", 7, "a"), (8, "ÄB c d e f", 7, "a"),
            (9, "äb c d e f", 7, "a"), (None, "two words", 7, "a")]
    got = run(spark, rows, "doc_id bigint, text string, n int, component string")
    assert got == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 29_996, 6), (7, 29_997, 6),
                   (8, 1, 8), (8, 1, 8), (9, 1, 9), (None, 1, None)]


def test_empty_table(spark):
    assert run(spark, []) == []
