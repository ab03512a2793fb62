import math
import random

import brute
import numpy as np
from finspark.llm.centroids import centroid_digest, cluster_vectors, nearest, neighbour_lists

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def run(spark, rows, **options):
    found, facts = cluster_vectors(spark.createDataFrame(rows, SCHEMA), **options)
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(map(tuple, found.collect()), key=key), {r["cluster"]: r.asDict() for r in facts.collect()}


def test_orchard_search_equals_all_distances_and_skips_some():
    rng = np.random.default_rng(3)
    centres = rng.integers(-2000, 2000, (40, 16))
    vectors = np.concatenate([centres[rng.integers(0, 40, 3000)] + rng.integers(-60, 60, (3000, 16)),
                              centres, rng.integers(-9000, 9000, (50, 16))])
    centres[7] = centres[3]  # a tie: the smaller number wins
    best, distance, computed = nearest(vectors, centres, neighbour_lists(centres))
    all_ = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
    assert 7 not in best and computed < all_.size / 3


def test_clusters_equal_brute_force(spark):
    rng = random.Random(9)
    vector = lambda: [rng.gauss(rng.choice((-1, 0, 1)), 0.2) for _ in range(8)]
    rows = [(i, vector(), 1) for i in range(150)]
    rows += [(200 + i, [0.25] * 8, None) for i in range(80)] + [(7, vector(), 2), (None, vector(), 3)]
    rows = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in rows]
    got, facts = run(spark, rows, k=6, dim=8)
    expected, centroids = brute.cluster_vectors([r[:2] for r in rows], k=6, dim=8)
    assert got == sorted(expected, key=lambda r: tuple((x is None, x) for x in r))
    assert [facts[i]["centroid"] for i in range(6)] == centroids
    for i, fact in facts.items():
        assert fact["cluster_inertia"] == sum(d for _, c, d in expected if c == i)
        assert fact["inertia"] == sum(d for _, _, d in expected) and fact["n"] == sum(c == i for _, c, _ in expected)


def test_edge_rows(spark):
    good = [0.5, -0.5]
    rows = [(1, good, 0), (2, None, 0), (3, [], 0), (4, [1.0], 0), (5, [1.0, None], 0), (6, [math.nan, 1.0], 0),
            (7, [math.inf, 1.0], 0), (8, [1e9, 0.0], 0), (1, good, 0)]
    got, facts = run(spark, rows, k=40, dim=2)
    assert got == [(1, 0, 0), (1, 0, 0)]  # two equal starts: ties go to the first, the second stays empty
    assert len(facts) == 2 and facts[1]["n"] == 0 and facts[1]["cluster_inertia"] == 0
    assert run(spark, [], dim=2) == ([], {})
    assert run(spark, [(None, good, 0)], dim=2) == ([], {})
    assert centroid_digest([1, -2]) == __import__("hashlib").sha256(b"1,-2").hexdigest()


def test_columns_of_clashing_names(spark):
    rows = spark.createDataFrame([(1, [0.5, 1.0], "a", 5, [1])], "vec_id bigint, embedding array<double>, id string, cluster int, v array<int>")
    assert [tuple(r) for r in cluster_vectors(rows, dim=2)[0].collect()] == [(1, 0, 0)]
