"""Centroid clustering: Lloyd rounds on integer vectors with Orchard's search for the nearest centroid.

Every centroid has the list of the others, nearest first.  A vector's search starts at the
centroid whose component sum is nearest to its own, walks that centroid's list, jumps to the
list of any centroid found closer, and marks what it has visited.  It stops strictly beyond
twice the current distance: a centroid further than that from the current one is further from
the vector than the current one, so the answer is exact, ties included.

Components become ``floor(scale * x)``, so distances and sums are exact integers and no result
depends on the order of rows.  A round is one pass over the quantised table (written once): every task
keeps ``k`` sums per component and sends these alone; of the data the driver sees ``k`` sums and ``k``
centroids a round, however large the table and whichever cluster is hot.

Defined cases: a vector counts if it has exactly ``dim`` components, none null, NaN, infinite
or, once scaled, of 2^24 or more (a squared distance must fit in 64 bits); others are left out.
Repeated rows count each, also as starting centroids; starts of equal id are ordered by their
components.  A row with a null id is clustered but starts no centroid.  With fewer than ``k``
startable vectors all of them start, with none the result is empty.  Other columns are ignored.
A sum of distances beyond 64 bits is null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.scratch import written

_LIMIT = 1 << 24
#: Vectors that are searched together (some 10 MB of working memory with 64 components).
_ROWS = 8192


def quantised(vectors: DataFrame, dim: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): the vectors that count, as integers."""
    scaled = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    in_range = F.forall(vector_col, lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) * scale < float(_LIMIT)), F.lit(False)))
    return (vectors.filter((F.size(vector_col) == dim) & in_range)
            .select(F.col(id_col).cast("bigint").alias("id"), F.transform(scaled, lambda x: x.cast("int")).alias("v")))


def first_centroids(rows: DataFrame, k: int, dim: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hash."""
    named = rows.filter("id is not null").withColumn(
        "hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    first = named.orderBy("hash", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64).reshape(-1, dim)


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid, the others by distance, and these squared distances."""
    apart = np.array([((centroids - c) ** 2).sum(axis=1) for c in centroids])
    np.fill_diagonal(apart, -1)
    order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
    return order, np.take_along_axis(apart, order, axis=1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, lists: tuple[np.ndarray, np.ndarray]
            ) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector by Orchard's search, and the distances computed."""
    order, apart = lists
    n, k = len(vectors), len(centroids)
    # The start: nearest component sum; any start gives the same answer.
    sums = centroids.sum(axis=1)
    by_sum = np.argsort(sums, kind="stable")
    own, ranked = vectors.sum(axis=1), sums[by_sum]
    right = np.clip(np.searchsorted(ranked, own), 0, k - 1)
    left = np.maximum(right - 1, 0)
    best = by_sum[np.where(np.abs(ranked[left] - own) <= np.abs(ranked[right] - own), left, right)]

    def distances(rows: np.ndarray, which: np.ndarray) -> np.ndarray:
        gap = vectors[rows] - centroids[which]
        return np.einsum("ij,ij->i", gap, gap)

    live = np.arange(n)
    found = distances(live, best)
    computed = n
    visited = np.zeros((n, k), bool)
    visited[live, best] = True
    place = np.zeros(n, np.int64)
    while len(live):
        live = live[place[live] < k - 1]
        at = best[live], place[live]
        live = live[apart[at] <= 4 * found[live]]
        other = order[best[live], place[live]]
        place[live] += 1
        new = ~visited[live, other]
        rows, other = live[new], other[new]
        visited[rows, other] = True
        d = distances(rows, other)
        computed += len(rows)
        closer = (d < found[rows]) | ((d == found[rows]) & (other < best[rows]))
        rows = rows[closer]
        best[rows], found[rows], place[rows] = other[closer], d[closer], 0
    return best, found, computed


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, part.column("v").flatten().to_numpy().astype(np.int64).reshape(-1, dim)


def _sum_rows(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, dim = centroids.shape
        lists = neighbour_lists(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for _, vectors in _blocks(batches, dim):
            cluster = nearest(vectors, centroids, lists)[0]
            order = np.argsort(cluster, kind="stable")
            some, first = np.unique(cluster[order], return_index=True)
            sums[some] += np.add.reduceat(vectors[order], first, axis=0)
            counts += np.bincount(cluster, minlength=k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"])
    return run


def _assign_rows(centroids: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = neighbour_lists(centroids)
        for part, vectors in _blocks(batches, centroids.shape[1]):
            cluster, distance, _ = nearest(vectors, centroids, lists)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])
    return run


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over all rows; an empty cluster's centroid stays."""
    sums = rows.mapInArrow(_sum_rows(centroids), "cluster int, n bigint, sums array<bigint>")
    total = (sums.select("cluster", "n", F.posexplode("sums").alias("i", "sum")).groupBy("cluster", "i")
             .agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")))
    out = centroids.copy()
    for cluster, i, n, own in total.collect():  # k * dim rows at most
        out[cluster, i] = own // n
    return out


def cluster_vectors(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
                    id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``(id, cluster, distance)`` of every vector that counts, and the centroids as
    ``(cluster, centroid, n, cluster_inertia, inertia)``; see the module text."""
    spark = vectors.sparkSession
    rows = written(quantised(vectors, dim, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(rows, k, dim, seed)
    found = "id bigint, cluster int, distance bigint"
    if not len(centroids):
        return (spark.createDataFrame([], found),
                spark.createDataFrame([], "cluster int, centroid array<bigint>, n bigint, cluster_inertia bigint, inertia bigint"))
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    assigned = written(rows.mapInArrow(_assign_rows(centroids), found), "assigned")
    own = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    whole = own.agg(F.sum("sum").alias("whole"))
    named = spark.createDataFrame([(i, c) for i, c in enumerate(centroids.tolist())], "cluster int, centroid array<bigint>")
    facts = (named.join(F.broadcast(own), "cluster", "left").join(F.broadcast(whole))
             .select("cluster", "centroid", F.coalesce("n", F.lit(0)).alias("n"),
                     F.coalesce("sum", F.lit(0).cast("decimal(38,0)")).try_cast("bigint").alias("cluster_inertia"),
                     F.col("whole").try_cast("bigint").alias("inertia")))
    return assigned, facts


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
