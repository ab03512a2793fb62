"""Substring dedup: repeated-phrase automata.

A window is ``size`` consecutive words of one document.  Each word that lies in a
window whose word sequence also starts in a document with a smaller id is removed;
windows are judged on the input, not on what is left.

1. Phrases.  In every window the ``seed``-word gram with the smallest hash is the window's
   seed (winnowing), so equal windows of two documents have equal seeds at equal places.
   On one side of its seed, at least, a window holds half of its other words: the seed with
   those (30 words for windows of 50) is the window's phrase.  Lines and runs of words that
   are common but shorter than a phrase never count.
2. Confirm.  Phrases are counted over all documents, packed by bucket of hashes, one
   entry per (phrase, text).  Those of two different texts or more recur.  Texts equal
   word for word are found by whole-text hashes and need no phrases.
3. Pieces.  A Bloom filter of the recurring phrases (16 bits each, two probes) lets a
   second pass over all documents send only the surroundings of recurring phrases, all
   windows around a phrase, to the shard of that phrase.  A false positive costs a
   piece and changes nothing.
4. Automata.  Every shard compiles its phrases into one Aho-Corasick automaton, streams
   its pieces through it in order of phrase and id, hashes the windows around every
   located phrase, and marks those whose sequence a document with a smaller id has.  A
   shard is worked off in runs of bounded size; of a phrase with very many pieces only
   window hashes go from one run to the next.
5. Marked spans go back to their documents by id.

Defined cases: null and empty texts have no words and stay as they are (null becomes an
empty kept text); a text shorter than a window loses nothing; equal ids do not
remove from each other; rows with a null id keep all words and remove none; repeated rows
each return a row; other columns are passed through, but for the names of the result
columns, which win.  Word sequences are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.scratch import shuffle_partitions, written
from finspark.llm.words import U64, Words, find_words, gram_hashes, mix, pack, row_sums, slices, unpack, word_hashes

#: Bits of the Bloom filter at most (128 MB); beyond it there are more false positives.
FILTER_BITS_MAX = 1 << 30
#: Bytes of pieces that a shard works off at once.
PIECE_BYTES = 4 << 20
_CHUNK_BITS = 20


def _text_hashes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """One hash per row over its whole word sequence."""
    place = np.arange(len(hashes), dtype=U64) - np.repeat(words.first[:-1], words.counts).astype(U64)
    return mix(row_sums(mix(hashes + mix(place + U64(1))), words.first) + words.counts.astype(U64))


def _phrase_length(size: int, seed: int) -> int:
    """A window holds its seed and, to one side or the other, half of what else it holds."""
    return seed + (size - seed) // 2


def _phrases(words: Words, hashes: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word index) of phrases such that every window holds one: the words from or up to the
    window's seed, its smallest gram (the leftmost of equals)."""
    grams, row = gram_hashes(hashes, seed), words.row
    span, out = size - seed + 1, []
    windows = len(hashes) - size + 1
    step = 1 << 19
    for at in range(0, max(windows, 0), step):
        n = min(step, windows - at)
        value = grams[at:at + n + span - 1]
        value = value >> U64(20) << U64(20) | np.arange(len(value), dtype=U64)
        pad = -len(value) % span
        table = np.concatenate([value, np.full(pad, ~U64(0))]).reshape(-1, span)
        ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[:n], ahead[span - 1:span - 1 + n])
        inside = row[at:at + n] == row[at + size - 1:at + size - 1 + n]
        chosen = np.zeros(len(value), bool)
        chosen[(least[inside] & U64((1 << 20) - 1)).astype(np.int64)] = True
        out.append(at + np.flatnonzero(chosen))
    seeds = np.unique(np.concatenate(out)) if out else np.zeros(0, np.int64)
    length = _phrase_length(size, seed)
    where = np.union1d(seeds, seeds - (length - seed))
    where = where[(where >= 0) & (where + length <= len(hashes))]
    where = where[row[where] == row[where + length - 1]]
    grams = gram_hashes(hashes, length)[where]
    # A phrase that comes again at once, as in a repeated word pair: in each stretch no longer than the
    # places a window has for a phrase, the first and the last will do; every window still holds one.
    stretch = where // max(size - length, 1)
    order = np.lexsort((where, stretch, row[where], grams))
    same = np.ones(max(len(order) - 1, 0), bool)
    for values in (grams, row[where], stretch):
        same &= values[order][1:] == values[order][:-1]
    inner = np.r_[False, same] & np.r_[same, False] if len(order) else np.zeros(0, bool)
    kept = np.sort(order[~inner])
    return grams[kept], where[kept]


def _text_rows():
    """(id, words, text hash) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = find_words(part.column("text"))
                full = _text_hashes(words, word_hashes(words)).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(words.counts), pa.array(full)],
                                                 ["id", "n_words", "full"])
    return run


def _phrase_rows(size: int, seed: int, buckets: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = find_words(part.column("text"))
                hashes = word_hashes(words)
                grams, where = _phrases(words, hashes, size, seed)
                full = _text_hashes(words, hashes)[words.row[where]]
                pairs = np.unique(np.stack([grams, full]), axis=1)
                bucket = ((pairs[0] >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
                cut = np.searchsorted(bucket, np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cut))
                if len(some):
                    packed = [[pack(values[cut[i]:cut[i + 1]], 8) for i in some] for values in pairs]
                    yield pa.RecordBatch.from_arrays([pa.array(some), *map(pa.array, packed)],
                                                     ["bucket", "grams", "fulls"])
    return run


def _recurring_rows(batches):
    """Phrases that two different texts have."""
    parts = [(g, f) for b in batches for g, f in zip(*(b.column(c).to_pylist() for c in ("grams", "fulls")))]
    if parts:
        grams, fulls = (unpack(b"".join(x), 8) for x in zip(*parts))
        order = np.argsort(grams)
        grams, fulls = grams[order], fulls[order]
        edge = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]])
        mixed = np.minimum.reduceat(fulls, edge) < np.maximum.reduceat(fulls, edge)
        yield pa.RecordBatch.from_arrays([pa.array(grams[edge][mixed].view(np.int64))], ["gram"])


def _probes(grams: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(mix(grams + U64(salt)) >> U64(64 - bits)).astype(np.int64) for salt in (1, 2)]


def _filter(recurring: DataFrame) -> Broadcast:
    """Bloom filter of the phrases, built in chunks by Spark; its size follows their number up to a bound."""
    spark = recurring.sparkSession
    bits = int(np.clip(np.ceil(np.log2(16 * max(recurring.count(), 1))), _CHUNK_BITS, np.log2(FILTER_BITS_MAX)))

    def positions(batches):
        for batch in batches:
            at = np.unique(np.concatenate(_probes(batch.column("gram").to_numpy().view(U64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> _CHUNK_BITS), pa.array(at)], ["chunk", "at"])

    def chunk(key, table):
        own = np.zeros(1 << _CHUNK_BITS, bool)
        own[table.column("at").to_numpy() & ((1 << _CHUNK_BITS) - 1)] = True
        return pa.table({"chunk": [key[0].as_py()], "own": [np.packbits(own, bitorder="little").tobytes()]})

    rows = (recurring.mapInArrow(positions, "chunk bigint, at bigint").distinct()
            .groupBy("chunk").applyInArrow(chunk, "chunk bigint, own binary"))
    whole = np.zeros(1 << bits >> 3, np.uint8)
    for row in rows.toLocalIterator():
        whole[row.chunk << _CHUNK_BITS - 3:(row.chunk + 1) << _CHUNK_BITS - 3] = np.frombuffer(row.own, np.uint8)
    return spark.sparkContext.broadcast((bits, whole))


_PIECE = ["gram", "id", "full", "at", "rel", "piece"]


def _piece_rows(size: int, seed: int, known: Broadcast):
    """The surroundings of every recurring phrase: all windows that hold it."""
    phrase = _phrase_length(size, seed)

    def run(batches):
        bits, whole = known.value
        for batch in batches:
            for part in slices(batch):
                words = find_words(part.column("text"))
                hashes = word_hashes(words)
                grams, where = _phrases(words, hashes, size, seed)
                hit, also = ((whole[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool) for p in _probes(grams, bits))
                grams, where = grams[hit & also], where[hit & also]
                row = words.row[where]
                left = np.maximum(where - (size - phrase), words.first[row])
                right = np.minimum(where + size, words.first[row + 1])
                full = _text_hashes(words, hashes).view(np.int64)[row]
                ids = part.column("id").take(pa.array(row))
                begin, end = words.start[left], words.end[right - 1]
                for a in range(0, len(row), 2000):
                    some = slice(a, a + 2000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(grams[some].view(np.int64)), ids[some], pa.array(full[some]),
                         pa.array((left - words.first[row])[some]), pa.array((where - left)[some]),
                         pa.array([words.data[x:y].tobytes() for x, y in zip(begin[some], end[some])], pa.binary())],
                        _PIECE)
    return run


def _located(words: Words, texts: list[str], wanted: dict[str, None]) -> tuple[np.ndarray, np.ndarray]:
    """(piece, word index in the piece) of every occurrence of every phrase, by one automaton.

    Texts and phrases have one space around each word, so a match is a match of words."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for text in wanted:
        automaton.add_word(text, len(text))
    automaton.make_automaton()
    piece, index = [], []
    for i, text in enumerate(texts):
        for end, length in automaton.iter(text):
            piece.append(i)
            index.append(text.count(" ", 0, end - length + 2) - 1)
    return np.array(piece, np.int64), np.array(index, np.int64)


def _gram_chunks(batches, most: int) -> Iterator[pa.Table]:
    """The rows of a partition in order, in runs of about ``most`` bytes of pieces."""
    held, size = [], 0
    for batch in batches:
        for part in slices(batch, "piece", most):
            held.append(part)
            size += part.column("piece").nbytes
            if size >= most:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _span_rows(size: int, seed: int, most: int = PIECE_BYTES):
    """Marked spans (id, text hash, first word, end word) of the documents of a shard's pieces.

    Pieces come by phrase and id.  They are worked off in runs of bounded size; of a phrase
    that continues in the next run only window hashes and their smallest ids are kept."""
    phrase = _phrase_length(size, seed)

    def run(batches):
        last, seen = None, (np.zeros(0, U64), np.zeros(0, np.int64))
        for table in _gram_chunks(batches, most):
            pieces, gram, rel = table.column("piece").chunk(0), table.column("gram").to_numpy(), table.column("rel").to_numpy()
            words = find_words(pieces)
            texts = [" " + b" ".join(x.as_py().split()).decode() + " " for x in pieces]
            wanted = {}
            for i in np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]):
                wanted[" " + " ".join(texts[i].split(" ")[1 + rel[i]:1 + rel[i] + phrase]) + " "] = None
            piece, index = _located(words, texts, wanted)

            counts, first = words.counts, words.first[:-1]
            low, high = np.maximum(index - (size - phrase), 0), np.minimum(index, counts[piece] - size)
            fits = low <= high
            change = np.zeros(len(words.start) + 1, np.int64)
            np.add.at(change, first[piece[fits]] + low[fits], 1)
            np.add.at(change, first[piece[fits]] + high[fits] + 1, -1)
            begin = np.flatnonzero(np.cumsum(change)[:-1])
            owner = words.row[begin]
            windows = gram_hashes(word_hashes(words), size)[begin]
            ids, fulls = (table.column(c).to_numpy()[owner] for c in ("id", "full"))
            begin = table.column("at").to_numpy()[owner] + begin - first[owner]
            old = seen if last == gram[0] else (seen[0][:0], seen[1][:0])
            all_windows, all_ids = np.concatenate([windows, old[0]]), np.concatenate([ids, old[1]])

            order = np.lexsort((all_ids, all_windows))
            edge = np.flatnonzero(np.r_[True, all_windows[order][1:] != all_windows[order][:-1]]) if len(order) else order
            least = np.repeat(all_ids[order][edge], np.diff(np.r_[edge, len(order)]))
            marked = order[all_ids[order] > least]
            marked = marked[marked < len(ids)]
            last, tail = gram[-1], gram[owner] == gram[-1]
            seen = windows[tail], ids[tail]
            if gram[0] == gram[-1]:
                seen = all_windows[order][edge], all_ids[order][edge]

            marked = marked[np.lexsort((begin[marked], fulls[marked], ids[marked]))]
            ids, fulls, begin = ids[marked], fulls[marked], begin[marked]
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (fulls[1:] != fulls[:-1]) | (begin[1:] > begin[:-1] + 1)
            start = np.flatnonzero(new)
            stop = np.r_[start[1:], len(ids)] - 1
            if len(start):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[start]), pa.array(fulls[start]), pa.array(begin[start]), pa.array(begin[stop] + size)],
                    ["id", "full", "begin", "end"])
    return run


def _cut_rows(names: list[str]):
    """Each document without its marked words."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                words = find_words(part.column("text"))
                full = _text_hashes(words, word_hashes(words)).view(np.int64)
                kept, removed = [], []
                for i, (text, spans) in enumerate(zip(part.column("text"), part.column("spans"))):
                    own = (text.as_py() or "").encode().split()
                    stay = np.ones(len(own), bool)
                    for span in spans.as_py() or ():
                        if span["full"] == full[i]:
                            stay[span["begin"]:span["end"]] = False
                    removed.append(len(own) - int(stay.sum()))
                    kept.append(b" ".join(own if not removed[-1] else [own[j] for j in np.flatnonzero(stay)]).decode())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(words.counts), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.string())], [*names, "n_words", "n_removed", "kept_text"])
    return run


def marked_spans(docs: DataFrame, size: int = 50, seed: int = 10) -> DataFrame:
    """``(id, full, begin, end)``: word spans of the text with hash ``full`` of document ``id`` that
    a document with a smaller id has too.  ``docs`` has ``id`` and ``text``."""
    parts = shuffle_partitions(docs.sparkSession)
    docs = docs.filter("id is not null")
    texts = written(docs.mapInArrow(_text_rows(), "id bigint, n_words bigint, full bigint")
                    .filter(F.col("n_words") >= size), "texts")
    firsts = texts.groupBy("full", "n_words").agg(F.min("id").alias("first"))
    copies = (texts.join(firsts, ["full", "n_words"]).filter("id > first")
              .select("id", "full", F.lit(0).cast("bigint").alias("begin"), F.col("n_words").alias("end")).distinct())
    recurring = written(
        docs.select("text").mapInArrow(_phrase_rows(size, seed, 4 * parts), "bucket bigint, grams binary, fulls binary")
        .repartition(parts, "bucket").mapInArrow(_recurring_rows, "gram bigint"), "recurring")
    pieces = docs.mapInArrow(_piece_rows(size, seed, _filter(recurring)),
                             "gram bigint, id bigint, full bigint, at bigint, rel bigint, piece binary")
    spans = (pieces.repartition(parts, "gram").sortWithinPartitions("gram", "id")
             .mapInArrow(_span_rows(size, seed), "id bigint, full bigint, begin bigint, end bigint"))
    return spans.union(copies)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 50,
                   seed: int = 10) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text`` (kept words, one space between)."""
    spans = (marked_spans(docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")), size, seed)
             .groupBy("id").agg(F.collect_list(F.struct("full", "begin", "end")).alias("spans")))
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text", text_col)]
    plain = [f"_{i}" for i in range(len(names))]
    rows = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)), F.col(text_col).alias("text"))
    joined = rows.join(spans, rows[plain[names.index(id_col)]].cast("bigint") == spans["id"], "left").select(
        *plain, "text", "spans")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in joined.select(*plain, "text").schema)
    cut = joined.mapInArrow(_cut_rows([*plain, "text"]), schema + ", n_words bigint, n_removed bigint, kept_text string")
    return cut.toDF(*names, text_col, "n_words", "n_removed", "kept_text")
