import random

import brute
import numpy as np
from finspark.llm import quality_model as Q
from finspark.llm.toxicity import held_out

RATED = "id bigint, text string, grade int"


def graded(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        grade = i % 3
        own = brute.prose(rng, rng.randrange(20, 80), 200).split()
        noise = (0.5, 0.15, 0.0)[grade]
        rows.append((i, " ".join(w.upper() + "!!" if rng.random() < noise else w for w in own), grade))
    return rows


def test_grades_of_unseen_texts(spark):
    model = Q.learn_quality(spark.createDataFrame(graded(450, 1), RATED), 3)
    assert model[1][0] < model[1][1]
    fresh = graded(150, 2)
    got = {r.doc_id: r for r in Q.score_quality(spark.createDataFrame(
        [r[:2] for r in fresh], "doc_id bigint, text string"), model).collect()}
    assert sum(round(got[i].expected_grade) == g for i, _, g in fresh) > 0.85 * len(fresh)
    assert sum(got[i].kept == (g > 0) for i, _, g in fresh) > 0.9 * len(fresh)
    again = Q.learn_quality(spark.createDataFrame(graded(450, 1)[::-1], RATED).repartition(5), 3)
    assert again[0] == model[0] and again[1] == model[1]


def test_gradient_fit_lowers_the_loss():
    rng = np.random.default_rng(0)
    row, index = np.repeat(np.arange(300), 5), rng.integers(0, 20, 1500)
    weights = rng.normal(size=20)
    z = np.bincount(row, weights[index])
    grade = np.digitize(z + rng.logistic(size=300) * 0.3, [-1, 1])
    w, cuts = Q.fit_ordinal(index, row, np.ones(1500), grade, 3)
    loss = lambda z, c: -np.log(Q._grade_probabilities(z, c)[grade, np.arange(300)]).mean()
    share = np.cumsum(np.bincount(grade) / 300)[:2]
    assert loss(np.bincount(row, w[index]), cuts) < 0.6 * loss(np.zeros(300), np.log(share / (1 - share)))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "w " * 60_000, "k"), (3, "w", "k"), (None, "é", "k")],
                                 "doc_id bigint, text string, kept string")
    for rows in ([], [(1, "a", 2), (2, "b", 2), (3, None, None)]):
        got = Q.score_quality(docs, Q.learn_quality(spark.createDataFrame(rows, RATED), 3)).collect()
        assert len(got) == 5 and len({round(r.tail_prob, 6) for r in got}) == 1
        assert got[0].__fields__ == ["doc_id", "expected_grade", "tail_prob", "kept"]
    assert Q.score_quality(docs.limit(0), Q.learn_quality(spark.createDataFrame([], RATED), 3)).collect() == []


def test_rated_rows_are_bounded_and_not_held_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(100)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2, int(i % 3 == 0)) for i in range(100)] + [(None, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    rows = Q.rated_rows(docs, labels, held_out(), max_rows=40).collect()
    assert len(rows) == 40 and all(r.grade == (0 if r.id % 2 == 0 else 1 if r.id % 3 == 0 else 2) for r in rows)
