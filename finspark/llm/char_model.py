"""Held-out code-point n-gram probabilities: modified Kneser-Ney in sorted hash arrays, a shard each.

A gram is ``ORDER`` characters (each the number of its UTF-8 bytes), so there is no fixed alphabet,
and the model grows with the corpus.  Texts are dealt over two folds by their hash; a fold's texts
are read by the model of the other fold, so that no text is its own evidence.

1. ``blocks``: one pass over the texts packs them into blocks of one language and fold, each with
   its distinct grams and their counts, in order and compressed.
2. ``requests``: the grams of a block are dealt over the shards of its language by their third and
   fourth character.  All that orders 3 to 5 need of a gram (its context, its shorter grams, the
   longer grams that continue them) has the same two characters, so these orders close in a shard.
3. ``shard_counts``: each shard sums its grams, counts continuations, and reports its counts of
   counts and its pairs of characters.  Orders 1 and 2 and the discounts are summed over shards.
4. ``answers``: each shard holds its grams as sorted hash arrays with the log probabilities of both
   folds' models, and answers each block with four bytes a gram, in the block's own order.
5. ``scored``: the blocks stay where they were written (bucketed by part); only answers move.

A gram meets a block once, however often it occurs in it.  A shard works in runs of ``ENTRIES``,
so its memory depends on its distinct grams, not on how many texts have them.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finspark.llm.scratch import if_small, written
from finspark.llm.words import U64, flat_text, gram_hashes, mix, row_sums

ORDER, WIDTH = 5, 4
#: Gram entries of blocks that a shard is aimed at, and that it merges at a time.
ENTRIES = 1 << 20
_LEVEL = 6


def pack_numbers(values: np.ndarray) -> bytes:
    """32-bit numbers, rows of any width, compressed by column and byte."""
    values = np.ascontiguousarray(values, "<u4").reshape(len(values), *values.shape[1:] or (1,))
    planes = np.ascontiguousarray(values.T).view(np.uint8).reshape(values.shape[1], -1, 4).transpose(0, 2, 1)
    return zstandard.ZstdCompressor(level=_LEVEL).compress(planes.tobytes())


def unpack_numbers(packed: bytes, width: int = 1) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8).reshape(width, 4, -1)
    values = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(width, -1).T
    return np.ascontiguousarray(values)


def pack_rows(rows: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return zstandard.ZstdCompressor(level=_LEVEL).compress(sink.getvalue())


def unpack_rows(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of all rows as numbers (their UTF-8 bytes), and each row's first."""
    data, offsets = flat_text(column)
    begins = (data & 0xC0) != 0x80
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(begins)
    size, out = np.diff(np.r_[at, len(data)]), data[at].astype(np.uint32)
    for i in range(1, WIDTH):
        more = np.flatnonzero(size > i)
        out[more] |= data[at[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return out, np.searchsorted(at, offsets)


def distinct_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams as rows of characters, counts, number of the gram that ends at each character, each row's
    first character); grams are in order of their third, fourth, second, first and last character."""
    chars, first = code_points(column)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    padded = np.full(len(chars) + (ORDER - 1) * (len(first) - 1), ord(" "), np.uint32)
    begin = np.arange(len(chars)) + (ORDER - 1) * row
    padded[begin + ORDER - 1] = chars
    hashes = gram_hashes(mix(padded.astype(U64) + U64(1)), ORDER)[begin] if len(chars) else np.zeros(0, U64)
    coded = pa.array(hashes).dictionary_encode()
    number, kinds = coded.indices.to_numpy(), len(coded.dictionary)
    some = np.zeros(kinds, np.int64)
    some[number[::-1]] = begin[::-1]
    grams = padded[some[:, None] + np.arange(ORDER)]
    order = np.lexsort(grams.T[[4, 0, 1, 3, 2]])
    rank = np.zeros(kinds, np.int64)
    rank[order] = np.arange(kinds)
    return grams[order], np.bincount(number, minlength=kinds)[order], rank[number], first


def _hash(chars: np.ndarray) -> np.ndarray:
    """64-bit hash of each row of characters."""
    out = np.zeros(len(chars), U64)
    for i in range(chars.shape[1]):
        out = mix(out + mix(chars[:, i].astype(U64) + U64(1)))
    return out


def _dealt(grams: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the grams by shard, shard of each in that order)."""
    shard = (_hash(grams[:, 2:4]) % U64(shards)).astype(np.int32)
    order = np.argsort(shard, kind="stable")
    return order, shard[order]


def shard_number(blocks: DataFrame) -> int:
    return 1 + (blocks.agg(F.sum("entries")).first()[0] or 0) // ENTRIES


def requests(blocks: DataFrame, shards: int) -> DataFrame:
    """Rows (lang, shard, part, block, fold, grams, counts) of blocks' (part, block, lang, fold, grams, counts)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.to_pylist():
                grams, counts = unpack_numbers(one["grams"], ORDER), unpack_numbers(one["counts"])[:, 0]
                order, shard = _dealt(grams, shards)
                own, begin = np.unique(shard, return_index=True)
                pieces = np.split(order, begin[1:]) if len(own) else []
                same = [pa.array([one[c]] * len(own), batch.schema.field(c).type) for c in ("part", "block", "lang", "fold")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(own, pa.int32()), pa.array([pack_numbers(grams[p]) for p in pieces], pa.binary()),
                     pa.array([pack_numbers(counts[p]) for p in pieces], pa.binary())],
                    ["part", "block", "lang", "fold", "shard", "grams", "counts"])
    return blocks.select("part", "block", "lang", "fold", "grams", "counts").mapInArrow(
        run, "part bigint, block bigint, lang string, fold int, shard int, grams binary, counts binary")


def _numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each distinct hash in ascending order, number of each)."""
    return np.unique(hashes, return_index=True, return_inverse=True)[1:]


def _per(number: np.ndarray, values: np.ndarray, kinds: int) -> np.ndarray:
    """Sums of both folds' values per number."""
    return np.stack([np.bincount(number, values[:, f], kinds) for f in (0, 1)], axis=1)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams in ascending order of their hash, and their counts in each fold."""
    grams, counts = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    some, number = _numbered(_hash(grams))
    return grams[some], _per(number, counts, len(some))


def _levels(grams: np.ndarray, counts: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """(counts, number of the context, number of the gram less its first character one level on) for
    orders 5, 4 and 3 of the distinct grams of a shard, and its pairs of a fourth and fifth character."""
    out = []
    for n in range(ORDER, 2, -1):
        own = grams[:, ORDER - n:]
        some, lower = _numbered(_hash(own[:, 1:]))
        out.append((counts, _numbered(_hash(own[:, :-1]))[1], lower))
        grams, counts = grams[some], _per(lower, (counts > 0).astype(float), len(some))
    return [*out, (counts,)], grams[:, 3:]


def _shard_rows(key, table):
    parts, waiting = [], 0
    for one in table.select(["fold", "grams", "counts"]).to_batches():
        for fold, grams, counts in zip(*(c.to_pylist() for c in one.columns)):
            both = np.zeros((len(grams := unpack_numbers(grams, ORDER)), 2))
            both[:, fold] = unpack_numbers(counts)[:, 0]
            parts.append((grams, both))
            waiting += len(grams)
            if waiting > ENTRIES:
                parts, waiting = [_merged(parts)], 0
    grams, counts = _merged(parts)
    levels, pairs = _levels(grams, counts)
    stats = [int((c[:, f] == i).sum()) for c, *_ in levels[:3] for f in (0, 1) for i in range(1, 5)]
    n = len(pairs)
    # Counts of 2^32 and more of one gram would need some 10^11 characters of the very same five: kept exact in two halves.
    halves = np.concatenate([counts % (1 << 32), counts // (1 << 32)], axis=1).astype(np.uint32)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * (n + 1), pa.string()), "shard": pa.array([key[1].as_py()] * (n + 1), pa.int32()),
        "a": pa.array([*pairs[:, 0].tolist(), None], pa.int64()), "b": pa.array([*pairs[:, 1].tolist(), None], pa.int64()),
        "c0": pa.array([*levels[3][0][:, 0].astype(int).tolist(), None], pa.int64()),
        "c1": pa.array([*levels[3][0][:, 1].astype(int).tolist(), None], pa.int64()),
        "stats": pa.array([None] * n + [stats], pa.list_(pa.int64())),
        "grams": pa.array([None] * n + [pack_numbers(grams)], pa.binary()),
        "counts": pa.array([None] * n + [pack_numbers(halves)], pa.binary())})


def shard_counts(asked: DataFrame) -> DataFrame:
    """Per shard one row with its grams, their counts and its counts of counts, and a row for each pair
    (fourth, fifth character) with the number of characters seen before it in each fold."""
    return asked.groupBy("lang", "shard").applyInArrow(
        _shard_rows, "lang string, shard int, a bigint, b bigint, c0 bigint, c1 bigint, stats array<bigint>, grams binary, counts binary")


def _discounts(n: list[Column]) -> Column:
    """Discounts of counts 1, 2, and 3 or more from the counts of counts 1 to 4; usual values where one is missing."""
    y = n[0] / F.nullif(n[0] + n[1] * 2, F.lit(0.0))
    own = [F.greatest(F.least(i + 1 - y * (i + 2) * n[i + 1] / F.nullif(n[i], F.lit(0.0)), F.lit(i + 0.95)), F.lit(0.1)) for i in range(3)]
    return F.when(F.least(*n) > 0, F.array(*own)).otherwise(F.array(*map(F.lit, (0.5, 0.75, 0.9))))


def _pair_probabilities(pairs: DataFrame) -> DataFrame:
    """(lang, a, b, p0, p1): the probability of b after a by each fold's model."""
    second = written(pairs.groupBy("lang", "a", "b").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "pairs")
    first = written(second.groupBy("lang", "b").agg(*(F.sum((F.col(f"c{f}") > 0).cast("bigint")).alias(f"c{f}") for f in (0, 1))), "characters")
    below = None
    for level, context in ((first, ["lang"]), (second, ["lang", "a"])):
        ones = lambda f: [F.sum((F.col(f"c{f}") == i).cast("double")) for i in range(1, 5)]
        cut = lambda f: F.when(F.col(f"c{f}") > 0, F.element_at(f"d{f}", F.least(F.col(f"c{f}"), F.lit(3)).cast("int"))).otherwise(0.0)
        whole = level.groupBy("lang").agg(F.count("*").alias("kinds"), *(_discounts(ones(f)).alias(f"d{f}") for f in (0, 1)))
        own = level.join(if_small(whole), "lang").withColumns({"k0": cut(0), "k1": cut(1)})
        sums = own.groupBy(context).agg(*(F.sum(f"{x}{f}").alias(f"{y}{f}") for x, y in (("c", "t"), ("k", "w")) for f in (0, 1)))
        own = own.join(sums, context)
        own = own.withColumns({f"b{f}": 1 / (F.col("kinds") + 1) for f in (0, 1)}) if below is None else own.join(below, ["lang", "b"])
        p = lambda f: F.when(F.col(f"t{f}") > 0, (F.col(f"c{f}") - F.col(f"k{f}") + F.col(f"w{f}") * F.col(f"b{f}"))
                             / F.nullif(F.col(f"t{f}"), F.lit(0))).otherwise(F.col(f"b{f}"))
        names = [f"p{f}" for f in (0, 1)] if below is not None else [f"b{f}" for f in (0, 1)]
        below = own.select(*dict.fromkeys(["lang", *context, "b"]), *(p(f).alias(name) for f, name in enumerate(names)))
    return below


def shard_models(counted: DataFrame) -> DataFrame:
    """All that a shard needs for its model: its row with grams and counts and the discounts of its
    language (orders 5, 4, 3), and rows (a, b, p0, p1) of its pairs."""
    shards, pairs = counted.filter("grams is not null"), counted.filter("grams is null")
    total = shards.groupBy("lang").agg(*(F.sum(F.col("stats")[i]).cast("double").alias(f"s{i}") for i in range(24)))
    cuts = total.select("lang", F.concat(*(_discounts([F.col(f"s{at + i}") for i in range(4)]) for at in range(0, 24, 4))).alias("cuts"))
    own = pairs.select("lang", "shard", "a", "b").join(_pair_probabilities(pairs), ["lang", "a", "b"])
    return (shards.select("lang", "shard", "grams", "counts").join(if_small(cuts), "lang")
            .unionByName(own, allowMissingColumns=True).select("lang", "shard", "a", "b", "p0", "p1", "grams", "counts", "cuts"))


def shard_logs(model: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(grams in ascending order of their hash, log probabilities by the models of both folds)."""
    whole = np.asarray(model.column("grams").is_valid())
    at = int(np.flatnonzero(whole)[0])
    grams = unpack_numbers(model.column("grams")[at].as_py(), ORDER)
    halves = unpack_numbers(model.column("counts")[at].as_py(), 4).astype(float)
    cuts = np.array(model.column("cuts")[at].as_py()).reshape(3, 2, 3)
    levels, pairs = _levels(grams, halves[:, :2] + halves[:, 2:] * (1 << 32))
    known = model.filter(pa.array(~whole))
    a, b, p0, p1 = (known.column(c).to_numpy() for c in ("a", "b", "p0", "p1"))
    keys = a.astype(U64) << U64(32) | b.astype(U64)
    order = np.argsort(keys)
    wanted = pairs[:, 0].astype(U64) << U64(32) | pairs[:, 1].astype(U64)
    p = np.stack([p0, p1], axis=1)[order[np.searchsorted(keys[order], wanted)]]
    for (counts, context, lower), cut in zip(levels[2::-1], cuts[::-1]):
        below, kinds = p[lower], context.max() + 1
        off = np.stack([np.where(counts[:, f] > 0, cut[f][np.clip(counts[:, f], 1, 3).astype(int) - 1], 0.0) for f in (0, 1)], axis=1)
        total, weight = (_per(context, x, kinds)[context] for x in (counts, off))
        p = np.where(total > 0, (counts - off + weight * below) / np.maximum(total, 1), below)
    return grams, np.log(p)


def _answer_rows(asked: pa.Table, model: pa.Table) -> pa.Table:
    parts, blocks, shards, logs = [], [], [], []
    if asked.num_rows:
        grams, known = shard_logs(model)
        hashes = _hash(grams)
        for one in asked.select(["part", "block", "shard", "fold", "grams"]).to_batches():
            for part, block, shard, fold, wanted in zip(*(c.to_pylist() for c in one.columns)):
                own = known[np.searchsorted(hashes, _hash(unpack_numbers(wanted, ORDER))), 1 - fold]
                parts.append(part), blocks.append(block), shards.append(shard)
                logs.append(pack_numbers(own.astype("<f4").view("<u4")))
    return pa.table({"part": pa.array(parts, pa.int64()), "block": pa.array(blocks, pa.int64()),
                     "shard": pa.array(shards, pa.int32()), "logs": pa.array(logs, pa.binary())})


def answers(asked: DataFrame, models: DataFrame) -> DataFrame:
    """(part, block, shard, logs): log probabilities of a block's grams of one shard, in their order there."""
    return asked.groupBy("lang", "shard").cogroup(models.groupBy("lang", "shard")).applyInArrow(
        _answer_rows, "part bigint, block bigint, shard int, logs binary")


def log_probabilities(blocks: DataFrame, shards: int) -> DataFrame:
    """(lang, gram, log0, log1): the whole model as a table; a gram is the bytes of its characters."""
    def run(key, model):
        grams, logs = shard_logs(model)
        return pa.table({"lang": pa.array([key[0].as_py()] * len(grams), pa.string()),
                         "gram": pa.array([g.tobytes() for g in grams], pa.binary()), "log0": logs[:, 0], "log1": logs[:, 1]})
    counted = written(shard_counts(requests(blocks, shards)), "counts")
    return shard_models(counted).groupBy("lang", "shard").applyInArrow(run, "lang string, gram binary, log0 double, log1 double")


def _score_rows(names: list[str], shards: int):
    def run(blocks: pa.Table, answered: pa.Table) -> pa.Table:
        found, out = {}, []
        for block, shard, logs in zip(*(answered.column(c).to_pylist() for c in ("block", "shard", "logs"))):
            found.setdefault(block, {})[shard] = logs
        for at in range(blocks.num_rows):
            texts = unpack_rows(blocks.column("body")[at].as_py()).combine_chunks()
            grams, _, number, first = distinct_grams(pa.concat_arrays(texts.column("text").chunks))
            own, logs = found.get(blocks.column("block")[at].as_py(), {}), np.zeros(len(grams))
            order, _ = _dealt(grams, shards)
            if len(grams):
                logs[order] = np.concatenate([unpack_numbers(own[s])[:, 0].copy().view("<f4") for s in sorted(own)])
            length = np.diff(first)
            mean = np.where(length > 0, -row_sums(logs[number], first) / np.maximum(length, 1), np.nan)
            out.append(texts.select(names).append_column("log_perplexity", pa.array(mean, pa.float64(), from_pandas=True)))
        return pa.concat_tables(out)
    return run


def scored(blocks: DataFrame, kinds: str) -> DataFrame:
    """The rows packed in ``body`` (columns ``kinds``, without text) with ``log_perplexity``: the mean negative
    log probability of their characters by the model of their language and the other fold."""
    shards = shard_number(blocks)
    asked = requests(blocks, shards)
    models = shard_models(written(shard_counts(asked), "counts"))
    names = [k.split()[0] for k in kinds.split(", ")]
    return (blocks.select("part", "block", "body").groupBy("part")
            .cogroup(answers(asked, models).groupBy("part"))
            .applyInArrow(_score_rows(names, shards), kinds + ", log_perplexity double"))
