"""SimHash near-duplicates by tiled exact comparison.

1. Fingerprints: every text's ``k``-word shingles (A-Z folded, one space between words, repeats
   included) are hashed by XXH64; a bit of the fingerprint is set if more than half have it.
2. Documents of equal fingerprint collapse into one, so groups of copies of any size cost
   nothing below.
3. Population counts of three parts of a fingerprint name its cell; there are at most
   22 * 22 * 23 cells, whatever the data.  Cells are dealt into tiles: a k-d split of the
   cells' numbers of fingerprints gives tiles of about equal size, each with the range of its
   population counts; a cell larger than a tile is dealt over several by hash.
4. Two fingerprints differ in at least as many bits as the population counts of their parts do
   in sum.  Pairs of tiles whose ranges are further apart than the radius are skipped; so are,
   within a pair of tiles, cells.  All else is compared by numpy's exclusive-or and bit count.
   No link is lost, and no table of buckets is searched.
5. A pair of tiles returns a spanning forest of its links, never all of them; the connected
   components of these are those of all links.

The number of comparisons is quadratic in the number of different fingerprints, as that of
any exact tiled comparison (the cells save some three quarters); memory is that of two tiles.

Defined cases: a null or empty text, or one without words, has the fingerprint zero, linked like
any other; a text of fewer than ``k`` words has one shingle, its whole sequence.  Repeated rows
return a row each.  A row with a null id has its fingerprint, a null component and links nothing.
Other columns are ignored; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm.scratch import components, if_small, written
from finspark.llm.words import SPACE, U64, find_words, slices

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32

#: Bits of the three parts whose population counts are compared.
PARTS = (21, 21, 22)
#: Fingerprints of a tile (a pair of tiles needs some 20 MB), and the least number of tiles.
TILE, LEAST_TILES = 1 << 16, 12
#: Shingles whose bits are unpacked together, and comparisons made together.
_UNPACKED, _TOGETHER = 1 << 16, 1 << 20


# ---------------------------------------------------------------------------------------------
# Fingerprints

def fingerprints(column: pa.Array, k: int, seed: int) -> np.ndarray:
    """64-bit SimHashes of all rows."""
    words = find_words(column)
    # One space after every word: the text of a shingle is then a span of bytes.
    solid = ~SPACE[words.data]
    keep = solid.copy()
    keep[words.end[words.end < len(solid)]] = True
    moved = np.zeros(len(solid) + 1, np.int64)
    np.cumsum(keep, out=moved[1:])
    text = np.where(solid, _FOLD[words.data], 0x20).astype(np.uint8)[keep].tobytes()
    start, end, counts = moved[words.start], moved[words.end - 1] + 1, words.counts

    size = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))  # shingles of each row
    first = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=first[1:])
    row = np.repeat(np.arange(len(size)), size)
    word = words.first[row] + np.arange(first[-1]) - first[row]
    last = np.minimum(word + k, words.first[row + 1]) - 1
    ones = np.zeros((len(size), 64), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(row), _UNPACKED):
        part = slice(at, at + _UNPACKED)
        hashes = np.fromiter((digest(text[a:b], seed) for a, b in zip(start[word[part]].tolist(), end[last[part]].tolist())),
                             U64, len(row[part]))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        rows, begin = np.unique(row[part], return_index=True)
        ones[rows] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").view(U64).ravel()


def _fingerprint_rows(k: int, seed: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                own = fingerprints(part.column("text"), k, seed)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(own.view(np.int64))], ["id", "print"])
    return run


# ---------------------------------------------------------------------------------------------
# Tiles

def population_counts(prints: np.ndarray) -> np.ndarray:
    """Population counts of the parts of each fingerprint."""
    out, low = [], 0
    for bits in PARTS:
        out.append(np.bitwise_count(prints >> U64(low) & U64((1 << bits) - 1)))
        low += bits
    return np.stack(out, axis=1).astype(np.int16)


def _parts_of(column: str) -> list:
    """Population counts as columns."""
    out, low = [], 0
    for i, bits in enumerate(PARTS):
        part = F.shiftrightunsigned(column, low).bitwiseAND(F.lit((1 << bits) - 1))
        out.append(F.bit_count(part).cast("int").alias(f"p{i}"))
        low += bits
    return out


def tile_directory(cells: np.ndarray, counts: np.ndarray, tile: int) -> tuple[np.ndarray, list[tuple]]:
    """(tile group of each cell, [(low, high, tiles)] of each group) by splitting cells at the
    median of the widest part until a group fits one tile or is a single cell."""
    group, boxes, todo = np.zeros(len(cells), np.int64), [], [np.arange(len(cells))]
    while todo:
        some = todo.pop()
        own, weight = cells[some], counts[some]
        low, high = own.min(axis=0), own.max(axis=0)
        part = int(np.argmax(high - low))
        if weight.sum() <= tile or low[part] == high[part]:
            group[some] = len(boxes)
            boxes.append((low, high, int(-(-weight.sum() // tile))))
            continue
        order = np.argsort(own[:, part], kind="stable")
        middle = own[order, part][np.searchsorted(np.cumsum(weight[order]), weight.sum() / 2)]
        middle = max(middle, low[part] + 1)
        todo += [some[own[:, part] < middle], some[own[:, part] >= middle]]
    return group, boxes


def near_groups(boxes: list[tuple], radius: int) -> list[tuple[int, int, int, int]]:
    """(group, tiles of it, other group, tiles of it) of groups whose population counts are near."""
    low, high = (np.array([b[i] for b in boxes], np.int64) for i in (0, 1))
    out = []
    for i, (_, _, n) in enumerate(boxes):
        gap = np.maximum(0, np.maximum(low[i:] - high[i], low[i] - high[i:])).sum(axis=1)
        out += [(i, n, int(j), boxes[j][2]) for j in i + np.flatnonzero(gap <= radius)]
    return out


# ---------------------------------------------------------------------------------------------
# Comparison of two tiles

class _Forest:
    """Connected components of 0 .. n - 1, fed with links in bulk."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.root[a], self.root[b]
        while (apart := a != b).any():
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up
            a, b = self.root[a], self.root[b]


def compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (of one tile with itself without ``right``)
    as pairs of fingerprints.  All cells near enough in population counts are compared."""
    sides = [left] if right is None else [left, right]
    sorted_sides = []
    for prints in sides:
        parts = population_counts(prints)
        order = np.lexsort(parts.T[::-1])
        prints, parts = prints[order], parts[order]
        new = np.r_[True, (parts[1:] != parts[:-1]).any(axis=1)]
        begin = np.flatnonzero(new)
        sorted_sides.append((prints, parts[begin], np.r_[begin, len(prints)]))
    (xs, x_cells, x_at), (ys, y_cells, y_at) = sorted_sides[0], sorted_sides[-1]
    base = 0 if right is None else len(xs)
    forest = _Forest(base + len(ys))
    y_size = np.diff(y_at)
    for i, cell in enumerate(x_cells):
        near = np.abs(y_cells - cell).sum(axis=1) <= radius
        if right is None:
            near[:i] = False  # the other order has met them
        near = np.flatnonzero(near)
        if not len(near):
            continue
        size = y_size[near]
        which = np.repeat(y_at[near] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
        others = ys[which]
        step = max(1, _TOGETHER // len(others))
        for at in range(x_at[i], x_at[i + 1], step):
            own = xs[at:min(at + step, x_at[i + 1])]
            hit = np.flatnonzero(np.bitwise_count(own[:, None] ^ others[None, :]) <= radius)
            if len(hit):
                forest.join(at + hit // len(others), base + which[hit % len(others)])
    prints = xs if right is None else np.concatenate([xs, ys])
    child = np.flatnonzero(forest.root != np.arange(len(prints)))
    return prints[child], prints[forest.root[child]]


def _compare_rows(radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for same, xs, ys in zip(*(batch.column(c) for c in ("same", "xs", "ys"))):
                left, right = (np.frombuffer(x.as_buffer(), U64) for x in (xs, ys))
                a, b = compare(left, None if same.as_py() else right, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])
    return run


def _pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("prints")
        yield pa.RecordBatch.from_arrays(
            [batch.column("tile"), pa.array([x.values.to_numpy().tobytes() for x in prints], pa.binary())], ["tile", "packed"])


def _tiles(spark: SparkSession, prints: DataFrame, cells: pd.DataFrame, tile: int, radius: int
           ) -> tuple[DataFrame, DataFrame, int]:
    """Packed tiles (tile, packed), the pairs (a, b) of tiles to compare, and their number."""
    names = [f"p{i}" for i in range(len(PARTS))]
    group, boxes = tile_directory(cells[names].to_numpy(np.int64), cells["n"].to_numpy(np.int64), tile)
    sizes = np.array([b[2] for b in boxes], np.int64)
    first = np.r_[0, np.cumsum(sizes)[:-1]]
    directory = cells[names].assign(first=first[group], tiles=sizes[group]).astype("int64")
    directory = F.broadcast(spark.createDataFrame(directory))  # at most one row for each of 11,638 cells
    number = F.col("first") + F.pmod(F.xxhash64("print"), F.col("tiles"))
    tiles = (prints.select("print", *_parts_of("print")).join(directory, names).select(number.alias("tile"), "print")
             .groupBy("tile").agg(F.collect_list("print").alias("prints"))  # a tile's size is bounded
             .mapInArrow(_pack_rows, "tile bigint, packed binary"))
    groups = [(int(first[i]), n, int(first[j]), m) for i, n, j, m in near_groups(boxes, radius)]
    near = spark.createDataFrame(groups, "i bigint, n bigint, j bigint, m bigint")
    pairs = (near.select(F.explode(F.sequence("i", F.col("i") + F.col("n") - 1)).alias("a"), "j", "m")
             .select("a", F.explode(F.sequence("j", F.col("j") + F.col("m") - 1)).alias("b")).filter("a <= b"))
    return tiles, pairs, sum(n * m for _, n, _, m in groups)


def simhash_links(prints: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect the different fingerprints ``print`` as all links do."""
    spark = prints.sparkSession
    names = [f"p{i}" for i in range(len(PARTS))]
    cells = prints.select(*_parts_of("print")).groupBy(*names).agg(F.count("*").alias("n")).toPandas()  # 11,638 rows at most
    if cells.empty:
        return spark.createDataFrame([], "a bigint, b bigint")
    tile = max(1, min(tile, int(cells["n"].sum()) // LEAST_TILES + 1))
    tiles, pairs, n = _tiles(spark, prints, cells, tile, radius)
    tiles = written(tiles, "tiles")
    side = lambda x, y: tiles.select(F.col("tile").alias(x), F.col("packed").alias(y))
    both = (pairs.join(side("a", "xs"), "a").join(side("b", "ys"), "b")
            .select((F.col("a") == F.col("b")).alias("same"), "xs", "ys"))
    # A task for each pair of tiles: their rows are small, their work is not.
    return both.repartition(min(n, 100_000)).mapInArrow(_compare_rows(radius), "a bigint, b bigint")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = 4,
                       seed: int = 42, tile: int = TILE) -> DataFrame:
    """``(id, print, component)`` for every row of ``docs``; see the module text."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = written(texts.mapInArrow(_fingerprint_rows(k, seed), "id bigint, print bigint"), "prints")
    prints = written(rows.filter("id is not null").groupBy("print").agg(F.min("id").alias("least")), "different")
    joined = components(written(simhash_links(prints, radius, tile), "links"), "a", "b").toDF("print", "root")
    placed = prints.join(joined, "print", "left").select("print", F.coalesce("root", "print").alias("root"), "least")
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = if_small(placed.join(least, "root").select("print", "component"))
    return rows.join(named, "print", "left").select(
        "id", "print", F.when(F.col("id").isNotNull(), F.col("component")).alias("component"))
