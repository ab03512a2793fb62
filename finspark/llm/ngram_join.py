"""N-gram Jaccard join: grouped prefix join over distinct word shingles.

Two texts link when their distinct ``k``-word shingle sets have a Jaccard
similarity of at least ``threshold`` percent.  The result is the connected
components of all links.

1. Texts with equal sets collapse into one class (sizes and set sums only).
2. All shingles of all texts are counted: (shingle, class) pairs travel packed, one
   row per slice and bucket of shingles.  Shingles of a single class cannot be part of
   a link and stop there.
3. Per class the shared shingles are put in one global order, rarest first.  A link
   needs a common shingle among the first ``n - ceil(t n) + 1``; of these only shared
   ones count.  Most classes have none and are done.
4. Classes of equal size and equal prefix are one group; only groups are joined, on
   prefix shingles, with the size and position filters.
5. First each group member is held against its group's leader, and each group against
   the leader it shares most shingles with; this joins large groups of near copies with
   one comparison per member.  Then every member that shares a prefix shingle with
   another component, and passes the filters, is held against all of that component, in
   blocks of bounded size.  Pairs inside a component need no test: they cannot change it.
   No link between different texts is lost.

Defined cases: a null or empty text, or one without words, has an empty set, links with
nothing and is its own component.  A text of fewer than ``k`` words has one shingle, its
whole sequence.  Repeated rows each return a row.  A row with a null id is returned with
a null component and takes no part in links.  Other columns are ignored.  Sets are compared by 48-bit
shingle keys: two different shingles of one pair share a key with probability of about
(set size)^2 / 2^48; equal sets are recognised by 128-bit sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.scratch import components, shuffle_partitions, written
from finspark.llm.words import U64, find_words, mix, pack, row_sums, shingle_sets, slices, unpack

_KEY, _MOST = 6, 65_535
#: Turns of one comparison per group, before all that is open is compared.
TURNS = 2
#: Classes of a component that are compared together.
BLOCK = 64


def _sets(batch: pa.RecordBatch, k: int):
    """Shingle keys, their rows, set sizes and two set sums of a slice."""
    keys, rows = shingle_sets(find_words(batch.column("text")), k)
    first = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    sums = [row_sums(mix(keys + U64(salt)), first).view(np.int64) for salt in (1 << 50, 3 << 50)]
    return keys, rows, np.diff(first), sums


def _set_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                _, _, n, (a, b) = _sets(part, k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n.astype(np.int64)), pa.array(a), pa.array(b)],
                    ["id", "n", "set", "more"])
    return run


def _by_bucket(buckets: int, bucket: np.ndarray, *columns: tuple[np.ndarray, int]) -> Iterator[list]:
    """(bucket, packed column, ...) for each bucket that has rows."""
    order = np.argsort(bucket, kind="stable")
    columns = [(values[order], width) for values, width in columns]
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(np.diff(cut)):
        yield [int(i), *(pack(values[cut[i]:cut[i + 1]], width) for values, width in columns)]


def _key_rows(k: int, buckets: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                keys, rows, _, (sets, _) = _sets(part, k)
                bucket = (keys * U64(buckets) >> U64(48)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
                got = list(_by_bucket(buckets, bucket, (keys, _KEY), (sets[rows], 8)))
                if got:
                    bucket, *packed = zip(*got)
                    yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), *map(pa.array, packed)],
                                                     ["bucket", "keys", "sets"])
    return run


def _columns(batches, **widths: int) -> list[np.ndarray]:
    """All packed columns of a partition, end to end."""
    parts = {name: [] for name in widths}
    for batch in batches:
        for name in widths:
            parts[name] += [x for x in batch.column(name).to_pylist() if x]
    return [unpack(b"".join(parts[name]), width) for name, width in widths.items()]


def _shared_rows(buckets: int):
    """(shingle, class) of shingles that two classes or more have, with the class count."""
    def run(batches):
        keys, sets = _columns(batches, keys=_KEY, sets=8)
        order = np.argsort(keys)
        keys = keys[order]
        edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
        often = np.repeat(np.diff(edge) > 1, np.diff(edge))
        keys, sets = keys[often], sets[order[often]]
        order = np.lexsort((sets, keys))
        keys, sets = keys[order], sets[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (sets[1:] != sets[:-1])
        keys, sets = keys[new], sets[new]
        edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, int)
        times = np.repeat(np.diff(edge), np.diff(edge))
        keys, sets, times = keys[times > 1], sets[times > 1], np.minimum(times[times > 1], _MOST)
        order = np.argsort(sets)
        sets = sets[order]
        bucket = np.mod(sets.view(np.int64), buckets)
        got = [[i, None, None, s, t, c] for i, s, t, c in
               _by_bucket(buckets, bucket, (sets, 8), (keys[order], _KEY), (times[order].astype(U64), 2))]
        for at in range(0, len(got), 1000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*got[at:at + 1000]), _ROUTED_TYPES)], _ROUTED)
    return run


_ROUTED = ["bucket", "set", "n", "sets", "keys", "times"]
_ROUTED_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_ROUTED_SCHEMA = "bucket int, set bigint, n bigint, sets binary, keys binary, times binary"


def _prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _prefix_rows(percent: int):
    """Per class that can have a link: its shared shingles and the shared part of its prefix."""
    def run(batches):
        parts, sizes = [], {}
        for batch in batches:
            for one, n, *packed in zip(*(batch.column(x).to_pylist() for x in _ROUTED[1:])):
                if n:
                    sizes[one] = n
                else:
                    parts.append(packed)
        sets, keys, times = (unpack(b"".join(x), w) for x, w in zip(zip(*parts), (8, _KEY, 2))) if parts else (
            [np.zeros(0, U64)] * 3)
        order = np.lexsort((keys, times, sets))
        sets, keys = sets[order], keys[order]
        edge = np.flatnonzero(np.r_[True, sets[1:] != sets[:-1], True]) if len(sets) else np.zeros(1, int)
        shared = np.diff(edge)
        n = np.array([sizes[x] for x in sets[edge[:-1]].view(np.int64).tolist()], np.int64)
        single = n - shared
        take = _prefix_length(n, percent) - single
        got = []
        for i in np.flatnonzero(take > 0):
            own = keys[edge[i]:edge[i + 1]]
            head = own[:take[i]]
            got.append((int(sets[edge[i]].view(np.int64)), int(n[i]), int(single[i]), np.sort(own).tobytes(),
                        head.view(np.int64), int(mix(mix(head) * (2 * np.arange(len(head), dtype=U64) + U64(1)))
                                                 .sum(dtype=U64).view(np.int64))))
            if len(got) == 500:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*got)], _PREFIXED)
                got = []
        if got:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*got)], _PREFIXED)
    return run


_PREFIXED = ["set", "n", "single", "keys", "prefix", "prefix_key"]


def _verify_rows(percent: int):
    def run(batches):
        for batch in batches:
            keep = []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n_a", "n_b", "keys_a", "keys_b"))):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (n + m - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _linked(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that pass the exact test."""
    side = lambda x: classes.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("keys").alias(f"keys_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "keys_a", "keys_b")
    return both.mapInArrow(_verify_rows(percent), "a bigint, b bigint")


def _fits(x: str, y: str, percent: int):
    """Size and position filters for a shingle at positions x.pos and y.pos of two ordered sets."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    best = F.lit(1) + F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos")) - 1
    return ((F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m))
            & (F.lit(100 + percent) * best >= F.lit(percent) * (n + m)))


def _grouped(members: DataFrame) -> DataFrame:
    """Members with the leader of their group: equal size, equal shared prefix."""
    leaders = members.groupBy("n", "prefix_key").agg(F.min("class").alias("leader"))
    return members.select("class", "n", "prefix_key").join(leaders, ["n", "prefix_key"]).select("class", "leader")


def _torn(postings: DataFrame, placed: DataFrame) -> DataFrame:
    """Postings, one per component of a group, of the shingles that still meet several components."""
    sizes = placed.groupBy("component").agg(F.count("*").alias("members"))
    kinds = placed.groupBy("leader", "component").agg(F.min("class").alias("class")).join(sizes, "component")
    entries = postings.join(kinds, "leader")
    torn = (entries.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
            .filter("lo < hi").select("key"))
    return written(entries.join(torn, "key"), "torn")


def _near_pairs(entries: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each entry's class with one class of another component: every shingle names an entry of
    its largest component, the first and in later turns others; the one named most is taken."""
    rank = F.struct("members", -F.col("class") if turn == 0 else F.xxhash64("class", F.lit(turn)))
    named = entries.groupBy("key").agg(F.max_by(F.struct("component", "class", "n", "pos"), rank).alias("p"))
    met = (entries.alias("x").join(named.select("key", "p.*").alias("y"), F.col("x.key") == F.col("y.key"))
           .filter("x.component <> y.component").filter(_fits("x", "y", percent))
           .groupBy(F.col("x.class").alias("a"), F.col("y.class").alias("b")).agg(F.count("*").alias("times")))
    return met.groupBy("a").agg(F.max_by("b", F.struct("times", "b")).alias("b"))


def _open_pairs(entries: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(class, component) of classes that may link with a class of another, larger component.

    The larger component counts as one posting with its extreme sizes and positions."""
    whole = entries.groupBy("key", "component", "members").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("left"))
    n, best = F.col("x.n"), F.least(F.col("x.n") - F.col("x.pos"), F.col("left"))
    fits = ((100 * F.col("hi") >= percent * n) & (100 * n >= percent * F.col("lo"))
            & ((100 + percent) * best >= percent * (n + F.col("lo"))))
    larger = F.struct("x.members", "x.component") < F.struct("y.members", "y.component")
    met = (entries.alias("x").join(whole.alias("y"), F.col("x.key") == F.col("y.key")).filter(larger).filter(fits)
           .select("x.leader", F.col("x.component").alias("own"), F.col("y.component").alias("component")).distinct())
    own = placed.select("leader", F.col("component").alias("own"), "class")
    return met.join(own, ["leader", "own"]).select("class", "component")


def _in_blocks(rows: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """Rows of (component, class) with the classes' sets, in lists of some ``BLOCK`` by component."""
    counts = rows.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    return (rows.join(counts, "component").withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
            .join(classes.select("class", "n", "keys"), "class").groupBy("component", "block")
            .agg(F.collect_list(F.struct("class", "n", "keys")).alias(name)).drop("block"))


def _block_rows(percent: int):
    """One link (a, b) at most of each class of one list with a class of the other."""
    def run(batches):
        for batch in batches:
            for one, two in zip(batch.column("xs"), batch.column("ys")):
                ys = two.as_py()
                keys = np.concatenate([np.frombuffer(y["keys"], U64) for y in ys])
                owner = np.repeat(np.arange(len(ys)), [len(y["keys"]) // 8 for y in ys])
                order = np.argsort(keys, kind="stable")
                keys, owner, sizes = keys[order], owner[order], np.array([y["n"] for y in ys])
                found = []
                for x in one.as_py():
                    own = np.frombuffer(x["keys"], U64)
                    low, high = np.searchsorted(keys, own), np.searchsorted(keys, own, side="right")
                    change = np.bincount(low, minlength=len(keys) + 1) - np.bincount(high, minlength=len(keys) + 1)
                    common = np.bincount(owner[np.cumsum(change)[:-1] > 0], minlength=len(ys))
                    links = np.flatnonzero(100 * common >= percent * (x["n"] + sizes - common))
                    found += [(x["class"], ys[links[0]]["class"])] if len(links) else []
                a, b = zip(*found) if found else ((), ())
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _open_links(open_: DataFrame, placed: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Links between each (class, component): every class is held against all of the component."""
    open_ = written(open_, "open")
    others = placed.select("component", "class").join(open_.select("component").distinct(), "component")
    both = _in_blocks(open_, classes, "xs").join(_in_blocks(others, classes, "ys"), "component").select("xs", "ys")
    return both.mapInArrow(_block_rows(percent), "a bigint, b bigint")


def _merged(placed: DataFrame, links: DataFrame) -> DataFrame:
    """``placed`` with the components that links between classes join."""
    of = lambda x: placed.select(F.col("class").alias(x), F.col("component").alias(f"c_{x}"))
    joined = components(links.join(of("a"), "a").join(of("b"), "b").select("c_a", "c_b"), "c_a", "c_b").toDF("component", "to")
    return written(placed.join(joined, "component", "left").select(
        "class", "leader", F.coalesce("to", "component").alias("component")), "placed")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                       percent: int = 80) -> DataFrame:
    """``(id, n, component)`` for every row of ``docs``; see the module text."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))

    rows = written(texts.mapInArrow(_set_rows(k), "id bigint, n bigint, set bigint, more bigint"), "sets")
    classes = (rows.filter("n > 0 and id is not null").groupBy("set", "more", "n")
               .agg(F.min("id").alias("class")))

    shared = (texts.filter("id is not null").mapInArrow(_key_rows(k, parts), "bucket int, keys binary, sets binary")
              .repartitionById(parts, "bucket").mapInArrow(_shared_rows(parts), _ROUTED_SCHEMA))
    sizes = classes.select(F.pmod("set", F.lit(parts)).cast("int").alias("bucket"), "set", "n",
                           *(F.lit(None).cast("binary").alias(c) for c in _ROUTED[3:]))
    prefixed = (shared.union(sizes).repartitionById(parts, "bucket")
                .mapInArrow(_prefix_rows(percent), "set bigint, n bigint, single bigint, keys binary, "
                                                   "prefix array<bigint>, prefix_key bigint"))
    members = written(prefixed.join(classes, ["set", "n"]).drop("set", "more"), "members")

    grouped = written(_grouped(members), "grouped")
    postings = written(
        members.join(grouped.select(F.col("leader").alias("class")).distinct(), "class")
        .select(F.col("class").alias("leader"), "n", "single", F.posexplode("prefix").alias("i", "key"))
        .select("key", "leader", "n", (F.col("single") + F.col("i")).alias("pos")), "postings")

    alone = grouped.withColumn("component", F.col("class"))
    inner = grouped.filter("class <> leader").select(F.col("class").alias("a"), F.col("leader").alias("b"))
    placed = _merged(alone, written(_linked(inner, members, percent), "links"))
    entries = _torn(postings, placed)
    for turn in range(TURNS):
        placed = _merged(placed, written(_linked(_near_pairs(entries, turn, percent), members, percent), "links"))
        entries = _torn(postings, placed)
    placed = _merged(placed, written(_open_links(_open_pairs(entries, placed, percent), placed, members, percent), "links"))

    found = placed.select(F.col("class").alias("node"), "component")
    named = (classes.join(found.withColumnRenamed("node", "class"), "class", "left")
             .select("set", "more", "n", F.coalesce("component", "class").alias("component")))
    return (rows.join(named, ["set", "more", "n"], "left")
            .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component")))
