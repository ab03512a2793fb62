"""Token counts: separator scan over flat, unindexed token streams.

A token file is nothing but token ids, each document followed by one end-of-document id;
there is no index.  ``write_tokens`` makes such streams from documents and stores them in
blocks of a fixed number of ids, cut without regard to documents, as Parquet rows in the
shared folder (any store Spark writes to, split at any block).  ``read_token_files``
brings flat binary files of other origin into the same blocks.

``count_tokens`` finds the end ids of every block with one vectorised search.  A block
yields the lengths of its pieces: the ids before its first end id, between end ids, and
after the last.  A prefix scan over the blocks of a stream, on one small row per block,
numbers the documents: the running count of end ids says which document a block's first
piece belongs to.  Pieces of a document that spans blocks are added up.

Defined cases: null and empty texts are documents without tokens (count 0); an id equal
to the end id cannot come from a text (texts are encoded as ordinary text); ids after the
last end id of a stream are a last, unended document, returned only if there are any;
repeated rows and null ids are documents like others, in the order written; empty tables
give empty results; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finspark.llm.scratch import written

#: Token ids in a block of a stream.
BLOCK_TOKENS = 1 << 16


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """A tiktoken vocabulary file, read by the driver (about a megabyte, whatever the data)."""
    with open(path, "rb") as file:
        return file.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    parts = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding("own", pat_str=pattern, special_tokens={},
                             mergeable_ranks={base64.b64decode(a): int(b) for a, b in parts})


def _stream_rows(ranks: bytes, pattern: str, end_id: int, dtype: str, block: int):
    """Blocks (stream, block, tokens) and, in between, the ids of the documents in order."""
    def rows(stream: int, name: str, values: list, more: list) -> pa.RecordBatch:
        at, tokens, first, ids = zip(*values) if name == "block" else more
        return pa.RecordBatch.from_arrays(
            [pa.array([stream] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(tokens, pa.binary()),
             pa.array(first, pa.int64()), pa.array(ids, pa.list_(pa.int64()))], _STREAM)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, made, known = TaskContext.get().partitionId(), encoding(ranks, pattern), 0
        held, size, number = [], 0, 0
        for batch in batches:
            ids = batch.column("id")
            for at in range(0, batch.num_rows, 1000):
                part = ids.slice(at, 1000)
                yield rows(stream, "ids", [], ([None], [None], [known], [part.to_pylist()]))
                known += len(part)
            for text in batch.column("text"):
                own = made.encode_ordinary(text.as_py() or "")
                held += [np.array(own, dtype), np.array([end_id], dtype)]
                size += len(own) + 1
                if size >= 16 * block:
                    flat = np.concatenate(held)
                    full = size // block
                    yield rows(stream, "block", [(number + i, flat[i * block:(i + 1) * block].tobytes(), None, None)
                                                 for i in range(full)], [])
                    held, size, number = [flat[full * block:]], size - full * block, number + full
        flat = np.concatenate(held) if held else np.zeros(0, dtype)
        left = [(number + i, flat[i * block:(i + 1) * block].tobytes(), None, None) for i in range(-(-size // block))]
        if left:
            yield rows(stream, "block", left, [])
    return run


_STREAM = ["stream", "block", "tokens", "first", "ids"]


def write_tokens(docs: DataFrame, ranks: bytes, pattern: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", dtype: str = "<u2", block: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """Token streams ``(stream, block, tokens)`` of all documents, one stream per task, and the
    documents' order in them ``(stream, ordinal, id)``."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    stored = written(texts.mapInArrow(_stream_rows(ranks, pattern, end_id, dtype, block),
                                      "stream bigint, block bigint, tokens binary, first bigint, ids array<bigint>"), "tokens")
    order = stored.filter("ids is not null").select("stream", "first", F.posexplode("ids").alias("i", "id")).select(
        "stream", (F.col("first") + F.col("i")).alias("ordinal"), "id")
    return stored.filter("tokens is not null").select("stream", "block", "tokens"), order


def read_token_files(spark: SparkSession, path: str, width: int, block: int = BLOCK_TOKENS) -> DataFrame:
    """Flat binary files as ``(stream, block, tokens)``; a stream is named by its file's path."""
    files = spark.read.format("binaryFile").load(path)
    step = block * width
    cut = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("length") / step) - 1, F.lit(0))),
                      lambda i: F.struct(i.alias("block"), F.col("content").substr((i * step + 1).cast("int"), F.lit(step)).alias("tokens")))
    return files.filter("length > 0").select(F.col("path").alias("stream"), F.explode(cut).alias("b")).select("stream", "b.*")


def _piece_rows(end_id: int, dtype: str):
    """Per block: the number of end ids and the lengths of the pieces they cut it into."""
    def run(batches):
        for batch in batches:
            ends, pieces = [], []
            for buffer in batch.column("tokens"):
                tokens = np.frombuffer(buffer.as_buffer(), dtype)
                at = np.flatnonzero(tokens == end_id)
                ends.append(len(at))
                pieces.append(np.diff(np.r_[-1, at, len(tokens)]) - 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, pieces)]), pa.int32()), pa.array(np.concatenate(pieces) if pieces else [], pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("stream"), batch.column("block"), pa.array(ends, pa.int64()), lists],
                                             ["stream", "block", "ends", "pieces"])
    return run


def count_tokens(blocks: DataFrame, end_id: int, dtype: str = "<u2") -> DataFrame:
    """``(stream, ordinal, n_tokens)`` of every document of the streams."""
    kind = blocks.schema["stream"].dataType.simpleString()
    found = blocks.select("stream", "block", "tokens").mapInArrow(
        _piece_rows(end_id, dtype), f"stream {kind}, block bigint, ends bigint, pieces array<bigint>")
    ahead = Window.partitionBy("stream").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = found.withColumn("before", F.coalesce(F.sum("ends").over(ahead), F.lit(0)))
    pieces = numbered.select("stream", "before", "ends", F.posexplode("pieces").alias("i", "n")).select(
        "stream", (F.col("before") + F.col("i")).alias("ordinal"), "n", (F.col("i") < F.col("ends")).alias("ended"))
    return (pieces.groupBy("stream", "ordinal").agg(F.sum("n").alias("n_tokens"), F.max("ended").alias("ended"))
            .filter("ended or n_tokens > 0").drop("ended"))
