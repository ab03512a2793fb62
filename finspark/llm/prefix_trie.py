"""Conversation prefix trie with subtree totals by time-forward processing.

Every conversation is rebuilt (``rebuilt_turns``); each different sequence of first ``d`` turns
is a node.  A node is known by its depth and two 64-bit exclusive-or sums of its turns'
hashes, salted by their places; texts are hashed where they are read.

Totals of subtrees (children, leaves, saved tokens) are passed to parents:

1. Nodes are cut into shards.  A node's weight is the number of turns below it, each conversation's
   counted; a topmost node of at most ``shard_rows`` is the root of a shard that holds its whole
   subtree.  The nodes above, the crown, are cut into ``BANDS`` bands of levels; a crown node's
   shard is named by its ancestor at the top of its band.
2. Within a shard (``_time_forward``), rows come sorted by Spark in reverse level order; each node
   takes the messages of its children off a priority queue, which spills sorted runs when it holds
   too many, and sends its own totals to its parent's place in the order.
3. Across shard roots: totals of subtree shards are summed by the crown node that they hang on; the
   bands' own sums are passed up the tree of band roots in the same way (a few for each task of
   the cluster, whatever the input); then every band is processed with the totals that enter it.

No task holds a hot prefix, a conversation or the children of a node; conversations and
copies of any size are dealt by range.  ``ends_sha256`` of a node is one running hash by its
nature: sorted ids are packed into pieces by range first, and one task streams the pieces.

Defined cases: rows with a null conv_id belong to no conversation and are left out; null roles
and texts are empty; null turns come first, ties are ordered by role and text and all
kept; a conversation without turns after rebuilding is a member of the root and ends there; an
empty table has no nodes; other columns are ignored.  Two different sequences of one depth
share a node with a probability of about (number of nodes)^2 / 2^128.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finspark.llm.scratch import if_small, shuffle_partitions, written

KEY = ["depth", "x", "y"]
UP = ["up_x", "up_y"]
#: Bands of levels that the crown is cut into, turns of a shard at most, and turns of a chunk of a conversation.
BANDS, SHARD_ROWS, CHUNK = 16, 1 << 20, 4096
#: Messages that a queue holds in memory, and ids of a piece.
HELD, PIECE = 500_000, 50_000
_WORD = r"[^\x20\x09-\x0D]+"


# ---------------------------------------------------------------------------------------------
# Rebuilt conversations

def _placed(turns: DataFrame) -> DataFrame:
    """(conv, place, a, b, words): turns by their place from 1 on.  Conversations are dealt by
    range, so one of any length spans several tasks; only texts that decide a tie travel."""
    spot = F.xxhash64("conv", "turn").alias("spot")
    tied = if_small(turns.groupBy("conv", "turn").agg(F.count("*").alias("n")).filter("n > 1").select(spot).distinct())
    hashed = turns.select("conv", "turn", "role", "text", spot, F.xxhash64("role", "text").alias("a"),
                          F.xxhash64(F.lit(1), "text", F.lit(2), "role").alias("b"),
                          F.regexp_count("text", F.lit(_WORD)).cast("bigint").alias("words"))
    known = tied.withColumn("tied", F.lit(True))
    slim = hashed.join(known, "spot", "left").select(
        "conv", "turn", *(F.when(F.col("tied"), F.col(c)).alias(c) for c in ("role", "text")), "a", "b", "words")
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    sorted_ = written(
        slim.repartitionByRange(shuffle_partitions(turns.sparkSession), "conv", *order)
        .withColumn("piece", F.spark_partition_id())
        .withColumn("local", F.row_number().over(Window.partitionBy("piece", "conv").orderBy(*order)))
        .select("conv", "piece", "local", "a", "b", "words"), "turns")
    across = Window.partitionBy("conv").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (sorted_.groupBy("conv", "piece").agg(F.count("*").alias("n"))
              .select("conv", "piece", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
              .filter("before > 0"))
    return (sorted_.join(if_small(before), ["conv", "piece"], "left")
            .select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("place"), "a", "b", "words"))


def rebuilt_turns(conversations: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """``(conv, depth, a, b, words)`` of the rebuilt turns, and ``(conv, length)`` of all conversations.

    Conversation c begins with the first h turns of c - c % family and goes on with its own after its
    first h; h = crc32(c) % heads."""
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = written(_placed(turns), "placed")
    first = placed.filter(F.col("place") < heads).withColumnRenamed("conv", "base")
    convs = (placed.groupBy("conv").agg(F.count("*").alias("own"))
             .withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % heads)
             .withColumn("base", F.col("conv") - F.col("conv") % family))
    lengths = first.groupBy("base").agg(F.max("place").alias("there"))
    convs = written(convs.join(lengths, "base", "left").select(
        "conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"), "own"), "conversations")
    head = (convs.filter("taken > 0").join(first, "base").filter("place <= taken")
            .select("conv", F.col("place").alias("depth"), "a", "b", "words"))
    tail = (placed.join(if_small(convs.select("conv", "h", "taken")), "conv").filter("place > h")
            .select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "a", "b", "words"))
    length = convs.select("conv", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return head.union(tail), length


def _keyed(turns: DataFrame) -> DataFrame:
    """(conv, depth, x, y, up_x, up_y, words): each turn with the key of its prefix and of the one before.

    Exclusive-or over chunks of a conversation, then over the turns of a chunk."""
    salted = turns.select("conv", "depth", "words", F.xxhash64("a", "b", "depth").alias("p"),
                          F.xxhash64("depth", "b", "a").alias("q"), F.floor((F.col("depth") - 1) / CHUNK).alias("chunk"))
    chunks = salted.groupBy("conv", "chunk").agg(F.bit_xor("p").alias("p0"), F.bit_xor("q").alias("q0"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    longer = if_small(chunks.select("conv", "chunk", *(F.bit_xor(c).over(earlier).alias(c) for c in ("p0", "q0"))).filter("chunk > 0"))
    within = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = salted.withColumns({"x": F.bit_xor("p").over(within), "y": F.bit_xor("q").over(within)})
    add = lambda c, d: F.col(c).bitwiseXOR(F.coalesce(F.col(d), F.lit(0)))
    return (local.join(longer, ["conv", "chunk"], "left")
            .select("conv", "depth", add("x", "p0").alias("x"), add("y", "q0").alias("y"), "p", "q", "words")
            .select("conv", *KEY, F.col("x").bitwiseXOR(F.col("p")).alias("up_x"),
                    F.col("y").bitwiseXOR(F.col("q")).alias("up_y"), "words"))


# ---------------------------------------------------------------------------------------------
# Time-forward processing

class MessageQueue:
    """A priority queue of tuples that keeps at most ``held`` in memory: when full, what it holds
    goes to a sorted run in the folder where Spark spills, and the runs are merged as they are read."""

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs = held, [], []

    def push(self, message: tuple) -> None:
        if len(self.heap) >= self.held:
            self._spill()
        heapq.heappush(self.heap, message)

    def _spill(self) -> None:
        # Unlinked from the start: nothing is left if the task ends or is lost.
        file = tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)
        for at in range(0, len(run := sorted(self.heap)), 1000):
            pickle.dump(run[at:at + 1000], file)
        file.seek(0)
        self.heap = []
        self._next(self._read(file))

    @staticmethod
    def _read(file) -> Iterator[tuple]:
        while True:
            try:
                yield from pickle.load(file)
            except EOFError:
                file.close()
                return

    def _next(self, run: Iterator[tuple]) -> None:
        """The head of a run stands for the run, among the heads of the others."""
        for message in run:
            heapq.heappush(self.runs, (message, id(run), run))
            return

    def take(self, place: tuple) -> Iterator[tuple]:
        """All messages for ``place`` (the first entries of a message), which no earlier one precedes."""
        n = len(place)
        while True:
            if self.heap and self.heap[0][:n] == place:
                yield heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:n] == place:
                message, _, run = heapq.heappop(self.runs)
                self._next(run)
                yield message
            else:
                return


_FORWARD = ["shard", *KEY, *UP, "is_root", "n_children", "n_leaves", "saved_tokens"]
_FORWARD_SCHEMA = ("shard bigint, depth bigint, x bigint, y bigint, up_x bigint, up_y bigint, is_root boolean, "
                   "n_children bigint, n_leaves bigint, saved_tokens bigint")


def _time_forward(held: int) -> Callable:
    """Rows of shards in reverse level order, with what enters them, to rows with subtree totals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, at = MessageQueue(held), None
        for batch in batches:
            out = []
            for shard, depth, x, y, up_x, up_y, is_root, children, leaves, saved in zip(
                    *(batch.column(c).to_pylist() for c in _FORWARD)):
                if shard != at:
                    queue, at = MessageQueue(held), shard
                for message in queue.take((-depth, x, y)):
                    children += 1
                    leaves += message[3]
                    saved += message[4]
                leaves = leaves or int(children == 0)
                if not is_root:
                    queue.push((1 - depth, up_x, up_y, leaves, saved))
                out.append((shard, depth, x, y, up_x, up_y, is_root, children, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], _FORWARD)
    return run


def time_forward(rows: DataFrame, held: int = HELD) -> DataFrame:
    """Subtree totals within shards; ``rows`` have the columns of ``_FORWARD``, the last three holding a
    node's own part and what enters from other shards.  Messages go to (-depth, x, y)."""
    return (rows.select(_FORWARD).repartition("shard")
            .sortWithinPartitions("shard", F.desc("depth"), "x", "y")
            .mapInArrow(_time_forward(held), _FORWARD_SCHEMA))


def _named(*columns: str):
    return F.xxhash64(*columns).alias("shard")


def subtree_totals(nodes: DataFrame, turns: DataFrame, shard_rows: int, bands: int = BANDS, held: int = HELD) -> DataFrame:
    """``(depth, x, y, n_children, n_leaves, saved_tokens)`` of nodes (KEY, UP, conv, weight, own):
    ``own`` is a node's part of the saved tokens, ``conv`` one of its members in ``turns``."""
    crown = written(nodes.filter(F.col("weight") > shard_rows), "crown")
    small = nodes.filter(F.col("weight") <= shard_rows)
    deepest = crown.agg(F.max("depth")).first()[0]
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("n_children", "n_leaves")]
    if deepest is None:  # the whole trie is one shard
        rows = small.select(F.lit(0).cast("bigint").alias("shard"), *KEY, *UP, (F.col("depth") == 0).alias("is_root"),
                            *zero, F.col("own").alias("saved_tokens"))
        return time_forward(rows, held).select(*KEY, "n_children", "n_leaves", "saved_tokens")

    # Shards that are whole subtrees: a root hangs on a crown node; its members name it.
    hung = crown.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"))
    roots = small.join(if_small(hung), ["depth", *UP], "left_semi").select(*KEY)
    member = (turns.filter(F.col("depth") <= deepest + 1).join(roots, KEY)
              .select("conv", F.col("depth").alias("root_depth"), _named(*KEY)))
    rows = small.join(member, "conv").select(
        "shard", *KEY, *UP, (F.col("depth") == F.col("root_depth")).alias("is_root"), *zero, F.col("own").alias("saved_tokens"))
    below = written(time_forward(rows, held), "below")
    totals = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    up = [(F.col("depth") - 1).alias("depth"), F.col("up_x").alias("x"), F.col("up_y").alias("y")]
    entering = below.filter("is_root").select(*up, "n_leaves", "saved_tokens").groupBy(*KEY).agg(
        F.count("*").alias("n_children"), *totals)

    # The crown in bands; a node's shard is its ancestor at the top of its band.
    height = max(1, -(-(deepest + 1) // bands))
    top = (F.col("depth") - F.col("depth") % height).alias("top")
    heads = turns.filter((F.col("depth") <= deepest) & (F.col("depth") % height == 0)).select(
        "conv", F.col("depth").alias("top"), _named(*KEY))
    origin = crown.filter("depth = 0").select(_named(*KEY)).first()[0]
    child = crown.filter("depth > 0").select(*up).groupBy(*KEY).agg(F.count("*").alias("crown_children"))
    banded = written(
        crown.withColumn("top", top).join(heads, ["conv", "top"], "left").withColumn("shard", F.coalesce("shard", F.lit(origin)))
        .join(entering, KEY, "left").join(child, KEY, "left")
        .select("shard", *KEY, *UP, (F.col("depth") == F.col("top")).alias("is_root"),
                F.coalesce("n_children", F.lit(0)).alias("n_children"),
                # A crown node that nothing hangs on is a leaf.
                F.when(F.col("n_children").isNull() & F.col("crown_children").isNull(), 1)
                .otherwise(F.coalesce("n_leaves", F.lit(0))).cast("bigint").alias("n_leaves"),
                (F.col("own") + F.coalesce("saved_tokens", F.lit(0))).alias("saved_tokens"),
                F.coalesce("crown_children", F.lit(0)).alias("crown_children")), "banded")
    # Band roots: sums of each band go up the tree of bands, in one task, as they are few.
    sums = banded.groupBy("shard").agg(*totals)
    parent = banded.select(F.col("shard").alias("up"), F.col("depth").alias("d"), F.col("x").alias("px"), F.col("y").alias("py"))
    band_roots = (banded.filter("is_root").select("shard", *KEY, *UP).join(sums, "shard")
                  .join(parent, (F.col("d") == F.col("depth") - 1) & (F.col("px") == F.col("up_x")) & (F.col("py") == F.col("up_y")), "left"))
    tree = written(band_roots, "bands")
    among = time_forward(tree.select(
        F.lit(0).cast("bigint").alias("shard"), F.floor(F.col("depth") / height).alias("depth"), F.col("shard").alias("x"),
        F.lit(0).cast("bigint").alias("y"), F.coalesce("up", F.lit(0)).alias("up_x"), F.lit(0).cast("bigint").alias("up_y"),
        (F.col("depth") == 0).alias("is_root"), F.lit(1).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens"), held)
    whole = among.select(F.col("x").alias("shard"), "n_leaves", "saved_tokens")
    entered = (tree.select("shard", *up, F.col("depth").alias("own_depth")).filter("own_depth > 0").drop("own_depth")
               .join(whole, "shard").groupBy(*KEY).agg(F.count("*").alias("more"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")))
    above = time_forward(banded.join(entered, KEY, "left").select(
        "shard", *KEY, *UP, "is_root", (F.col("n_children") + F.coalesce("more", F.lit(0))).alias("n_children"),
        (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")), held)
    return below.union(above).select(*KEY, "n_children", "n_leaves", "saved_tokens")


# ---------------------------------------------------------------------------------------------
# Digests of the members that end at a node

def _id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of ascending ids of a node as one text each."""
    key, ids = None, []
    piece = lambda: pa.RecordBatch.from_arrays(
        [*(pa.array([v], pa.int64()) for v in (*key, ids[0])), pa.array([",".join(map(str, ids))])], [*KEY, "first", "ids"])
    for batch in batches:
        for *own, conv in zip(*(batch.column(c).to_pylist() for c in (*KEY, "conv"))):
            if ids and (own != key or len(ids) == PIECE):
                yield piece()
                ids = []
            key = own
            ids.append(conv)
    if ids:
        yield piece()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    row = lambda: [*key, state.hexdigest()]
    for batch in batches:
        out = []
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
            if own != key:
                if key:
                    out.append(row())
                key, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(("," + ids).encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [*KEY, "ends_sha256"])
    if key:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row()], [*KEY, "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of rows (KEY, conv): the ascending ids of each node, joined by commas."""
    n = shuffle_partitions(ends.sparkSession)
    pieces = (ends.repartitionByRange(n, *KEY, "conv").sortWithinPartitions(*KEY, "conv")
              .mapInArrow(_id_pieces, "depth bigint, x bigint, y bigint, first bigint, ids string"))
    return (pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
            .mapInArrow(_digest_rows, "depth bigint, x bigint, y bigint, ends_sha256 string"))


# ---------------------------------------------------------------------------------------------

def prefix_trie(conversations: DataFrame, family: int = 20, heads: int = 4, shard_rows: int | None = None,
                bands: int = BANDS, held: int = HELD) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the key ``x``, ``y``; see the module text."""
    spark = conversations.sparkSession
    turns, lengths = rebuilt_turns(conversations, family, heads)
    lengths = written(lengths, "lengths")
    turns = written(_keyed(turns), "prefixes")
    long = turns.join(if_small(lengths), "conv")
    none = F.lit(0).cast("bigint")
    # A turn's row stands for one member of its node; conversations stand for themselves at the root.
    rows = long.select(*KEY, *UP, "conv", "words", (F.col("length") - F.col("depth") + 1).alias("weight"), (F.col("length") == F.col("depth")).alias("ends"))
    at_root = lengths.select(none.alias("depth"), none.alias("x"), none.alias("y"), none.alias("up_x"), none.alias("up_y"), "conv",
                             none.alias("words"), (F.col("length") + 1).alias("weight"), (F.col("length") == 0).alias("ends"))
    members = rows.union(at_root)
    nodes = written(
        members.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.first("up_x").alias("up_x"),
                                  F.first("up_y").alias("up_y"), F.first("words").alias("words"), F.sum("weight").alias("weight"))
        .withColumn("own", (F.col("n_convs") - 1) * F.col("words")), "nodes")
    if shard_rows is None:
        total = nodes.filter("depth = 0").agg(F.sum("weight")).first()[0] or 0
        shard_rows = max(1, min(SHARD_ROWS, total // (4 * shuffle_partitions(spark))))
    totals = subtree_totals(nodes, turns, shard_rows, bands, held)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("up_x"), F.col("y").alias("up_y"),
                           F.col("conv").alias("parent_conv_id"))
    digests = end_digests(members.filter("ends").select(*KEY, "conv"))
    none_ends = hashlib.sha256(b"").hexdigest()
    return (nodes.select(*KEY, *UP, "conv", "n_convs").join(parents, ["depth", *UP], "left").join(totals, KEY).join(digests, KEY, "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none_ends)).alias("ends_sha256"), "x", "y"))
