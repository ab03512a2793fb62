"""Quality rules by n-gram perplexity: a modified Kneser-Ney model per language.

The model counts 5-grams of characters of all documents, without a fixed alphabet, and grows
with the corpus (``char_model``).  Every value of the language column has its own model and
its own band; null is one of them.  Documents are dealt over two folds by the hash of their
text, and each is read by its language's model of the other fold, so that it is no evidence
for itself (exact copies share a fold; near copies may not).

A document's log perplexity is its mean negative log probability.  Per language the band
reaches ``width`` interquartile ranges beyond the quartiles of all documents that pass the
base rules, and further for short texts, whose means vary more (by the root of
1 + 50 / words); documents outside are rejected.  Where a language has enough labelled
documents, its width is the one that best parts good ones from poor ones among them.

Base rules: too few words (under 20), or more than 30 percent of the words in 8-word
windows that occur twice or more in the text.

Defined cases: a null text is empty; an empty text fails the base rules and has a null
perplexity; null languages are one language; repeated rows each return a row and each
count; ids may be null; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.char_model import distinct_grams, pack_numbers, pack_rows, scored
from finspark.llm.scratch import bucketed, if_small, written
from finspark.llm.words import SPACE, U64, Words, find_words, gram_hashes, row_sums, slices, span_hashes, word_hashes

#: Words from which on a band is hardly wider than its language's.
SHORT = 50
#: Bytes of text in a block, held by a task before it gives up its fullest, and blocks in a part.
BLOCK_BYTES, HELD_BYTES, PART_BLOCKS = 4 << 20, 32 << 20, 32
#: Widths that labels choose from; the share of good documents to keep; good and poor labels needed.
WIDTHS, LEAST_KEPT, LEAST_LABELS = [i / 4 for i in range(2, 41)], 0.95, 50


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def _repeat_words(words: Words, hashes: np.ndarray, size: int = 8) -> np.ndarray:
    """Per row, the words in windows of ``size`` words that occur twice or more in the row."""
    grams, row = gram_hashes(hashes, size), words.row
    begin = np.flatnonzero(row[:len(grams)] == row[size - 1:]) if len(grams) else np.zeros(0, np.int64)
    both = grams[begin] >> U64(16) | row[begin].astype(U64) << U64(48)
    ordered = np.sort(both)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    change = np.zeros(len(hashes) + 1, np.int64)
    if len(twice):
        begin = begin[twice[np.minimum(np.searchsorted(twice, both), len(twice) - 1)] == both]
        change[begin] += 1
        change[begin + size] -= 1
    return row_sums((np.cumsum(change)[:-1] > 0).astype(np.int64), words.first)


def _repeat_lines(words: Words) -> np.ndarray:
    """Per row, the lines with a word that equal an earlier line."""
    breaks = np.flatnonzero(words.data == 0x0A)
    starts = np.sort(np.r_[words.offsets[:-1], breaks + 1])
    ends = np.sort(np.r_[breaks, words.offsets[1:]])
    full = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends = starts[full], ends[full]
    row = np.searchsorted(words.offsets, starts, side="right") - 1
    order = np.lexsort((span_hashes(words.data, starts, ends), row))
    lines = np.stack([span_hashes(words.data, starts, ends)[order], row[order].astype(U64)])
    again = (lines[:, 1:] == lines[:, :-1]).all(axis=0)
    return np.bincount(row[order][1:][again], minlength=len(words.first) - 1)


def _block(part: int, block: int, pieces: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(pieces)
    grams, counts, _, _ = distinct_grams(pa.concat_arrays(rows.column("text").chunks))
    lang, fold = rows.column("lang")[0].as_py(), rows.column("fold")[0].as_py()
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([block], pa.int64()), pa.array([lang], pa.string()), pa.array([fold], pa.int32()),
         pa.array([pack_rows(rows.drop(["fold"]))], pa.binary()), pa.array([len(grams)], pa.int64()),
         pa.array([pack_numbers(grams)], pa.binary()), pa.array([pack_numbers(counts)], pa.binary())],
        ["part", "block", "lang", "fold", "body", "entries", "grams", "counts"])


def _rule_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their base numbers in packed blocks of one language and fold, and each block's distinct grams."""
    task, made, held, size = TaskContext.get().partitionId() << 32, 0, {}, {}

    def flush(keys):
        nonlocal made
        for key in keys:
            yield _block(task + made // PART_BLOCKS, task + made, held.pop(key))
            size.pop(key)
            made += 1

    for batch in batches:
        for part in slices(batch):
            words = find_words(part.column("text"))
            hashes = word_hashes(words)
            solid = ((words.data & 0xC0) != 0x80) & ~SPACE[words.data]
            numbers = [words.counts, row_sums(solid.astype(np.int64), words.offsets),
                       row_sums(_SYMBOL[words.data], words.offsets), _repeat_lines(words), _repeat_words(words, hashes)]
            rows = pa.RecordBatch.from_arrays([*(part.column(c) for c in ("id", "lang", "fold", "text")),
                                               *(pa.array(x.astype(np.int64)) for x in numbers)], ["id", "lang", "fold", "text", *_RULES[2:-1]])
            key = np.char.add(np.asarray(part.column("lang").to_pylist(), str), np.asarray(part.column("fold").to_pylist(), str))
            for one in np.unique(key).tolist():
                some = np.flatnonzero(key == one)
                held.setdefault(one, []).append(rows.take(pa.array(some)))
                size[one] = size.get(one, 0) + int(np.diff(words.offsets)[some].sum())
                if size[one] >= BLOCK_BYTES:
                    yield from flush([one])
            while sum(size.values()) >= HELD_BYTES:
                yield from flush([max(size, key=size.get)])
    yield from flush(sorted(held))


_RULES = ["id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_perplexity"]
_KINDS = "id bigint, lang string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _widths(rules: DataFrame, bands: DataFrame, labels: DataFrame, width: float) -> DataFrame:
    """(lang, width) by the labelled documents of each language that pass the base rules: the width with the
    largest sum of good documents kept and poor ones rejected (shares) among those that keep ``LEAST_KEPT``."""
    rated = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    reach = F.greatest(F.col("low") - F.col("log_perplexity"), F.col("log_perplexity") - F.col("high"), F.lit(0.0))
    away = (rules.filter("not base_failed").join(rated, F.col("id") == F.col("doc_id")).join(bands, "lang")
            .select("lang", "quality", (reach / _wider() / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))).alias("away")))
    good, share = F.col("quality") > 0, {}
    for w in WIDTHS:
        inside = F.coalesce(F.col("away") <= w, F.lit(False))
        share[w] = [F.avg(F.when(x, inside.cast("double"))) for x in (good, ~good)]
    choice = F.array_max(F.array(*(F.when(g >= LEAST_KEPT, F.struct((g - b).alias("gain"), F.lit(w).alias("width")))
                                   for w, (g, b) in share.items())))
    enough = F.least(F.sum(good.cast("int")), F.sum((~good).cast("int"))) >= LEAST_LABELS
    return away.groupBy("lang").agg(F.coalesce(F.when(enough, choice["width"]), F.lit(float(width))).alias("width"))


def _wider():
    return F.sqrt(1 + F.lit(float(SHORT)) / F.greatest(F.col("n_words"), F.lit(1)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  width: float = 4.5, labels: DataFrame | None = None) -> DataFrame:
    """One row per document: the base numbers, ``log_perplexity``, the band ``low`` to ``high`` of
    its language, ``base_failed`` and ``kept``.  Rows of (doc_id, quality) in ``labels`` choose the
    width of their language; ``width`` is for languages with too few of them."""
    key = F.concat(F.lit("="), F.col(lang_col).cast("string"))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(key, F.lit("")).alias("lang"),
                        F.pmod(F.xxhash64(text_col), F.lit(2)).cast("int").alias("fold"), F.col(text_col).alias("text"))
    blocks = bucketed(texts.mapInArrow(
        _rule_rows, "part bigint, block bigint, lang string, fold int, body binary, entries bigint, grams binary, counts binary"), "part")
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    read = scored(blocks, _KINDS)
    rules = written(read.withColumn("base_failed", failed), "rules")
    quartiles = (rules.filter("not base_failed").groupBy("lang")
                 .agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 10_000).alias("q")))
    bands = written(quartiles.select("lang", F.col("q")[0].alias("low"), F.col("q")[1].alias("high")), "bands")
    if labels is None:
        widths = bands.select("lang", F.lit(float(width)).alias("width"))
    else:
        widths = _widths(rules, bands, labels, width)
    reach = F.coalesce(F.col("width"), F.lit(float(width))) * (F.col("high") - F.col("low"))
    bands = bands.join(widths, "lang", "left").select("lang", "low", "high", reach.alias("reach"))
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    return rules.join(if_small(bands), "lang", "left").withColumns({
        "low": F.col("low") - F.col("reach") * _wider(), "high": F.col("high") + F.col("reach") * _wider()}).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("lang", "reach")
