"""Vectorised word and window hashing over Arrow string columns.

A word is a maximal run of bytes other than space and 0x09-0x0D.  All
functions work on one flat byte buffer for a whole slice of rows, so there is
no Python loop per row.  Hashes are 64-bit polynomial sums over a fixed random
byte table, finished with a mixing step; windows never cross a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.int64).astype(U64)
_BYTE_LOWER = _BYTE[_LOWER]

_MASK = (1 << 64) - 1
_BLOCK = 1 << 17


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64 (kept by each process)."""
    if base in _POWERS:
        return _POWERS[base]
    up = np.full(_BLOCK + 1, base, U64)
    up[0] = 1
    down = np.full(_BLOCK + 1, pow(base, -1, 1 << 64), U64)
    down[0] = 1
    _POWERS[base] = np.cumprod(up), np.cumprod(down)
    return _POWERS[base]


_WORD, _GRAM = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def slices(batch: pa.RecordBatch, text: str = "text", max_bytes: int = 4 << 20, max_rows: int = 60_000
           ) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text (a longer row stands alone)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
    start, total = 0, np.cumsum(size)
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = int(np.searchsorted(total, before + max_bytes, side="right"))
        end = min(max(end, start + 1), start + max_rows, batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows end to end, and the offset of each row (nulls are empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


@dataclass
class Words:
    """Word positions of a slice of rows: bytes [start, end) and the row of each word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # index of each row's first word; one more entry for the end

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(column: pa.Array) -> Words:
    data, offsets = flat_text(column)
    solid = ~SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    begins[cuts] = solid[cuts]
    ends[cuts - 1] = solid[cuts - 1]
    start = np.flatnonzero(begins)
    return Words(data, offsets, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets))


def _long_word(values: np.ndarray) -> int:
    total, scale, (up, _) = 0, 1, _powers(_WORD)
    for at in range(0, len(values), _BLOCK):
        part = values[at:at + _BLOCK]
        total += scale * int(np.sum(part * up[:len(part)], dtype=U64))
        scale = scale * pow(_WORD, _BLOCK, 1 << 64) & _MASK
    return total & _MASK


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of ascending, disjoint byte spans; ``lower`` folds A-Z."""
    table, (up, down) = _BYTE_LOWER if lower else _BYTE, _powers(_WORD)
    out = np.zeros(len(start), U64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = int(np.searchsorted(end, base + _BLOCK, side="right"))
        if stop <= at:
            out[at] = _long_word(table[data[base:end[at]]])
            at += 1
            continue
        total = np.zeros(int(end[stop - 1]) - base + 1, U64)
        np.cumsum(table[data[base:end[stop - 1]]] * up[:len(total) - 1], out=total[1:])
        s = start[at:stop] - base
        out[at:stop] = (total[end[at:stop] - base] - total[s]) * down[s]
        at = stop
    return mix(out + (end - start).astype(U64))


def word_hashes(words: Words, lower: bool = False) -> np.ndarray:
    return span_hashes(words.data, words.start, words.end, lower)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive hashes (rows are not regarded)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out, step, (up, down) = np.empty(n, U64), _BLOCK - k, _powers(_GRAM)
    for at in range(0, n, step):
        stop = min(at + step, n)
        part = hashes[at:stop + k - 1]
        total = np.zeros(len(part) + 1, U64)
        np.cumsum(part * up[:len(part)], out=total[1:])
        m = stop - at
        out[at:stop] = (total[k:k + m] - total[:m]) * down[:m]
    return mix(out)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive entries of ``first`` (wraps for integers)."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def shingle_sets(words: Words, k: int, bits: int = 48, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of the distinct ``k``-word shingles of each row, by row then key.

    A row of fewer than ``k`` words has its whole sequence as one shingle; a row
    without words has none.  Keys keep ``bits`` bits, so that a key and a row
    number of up to ``64 - bits`` bits sort as one integer.
    """
    hashes, counts, row = word_hashes(words, lower), words.counts, words.row
    grams = gram_hashes(hashes, k)
    whole = row[:len(grams)] == row[k - 1:] if len(grams) else np.zeros(0, bool)
    keys, rows = [grams[whole]], [row[:len(grams)][whole]]
    short = np.flatnonzero((counts > 0) & (counts < k))
    for n in np.unique(counts[short]):
        some = short[counts[short] == n]
        at = words.first[some][:, None] + np.arange(n)
        value = (hashes[at] * _powers(_GRAM)[0][:n]).sum(axis=1, dtype=U64)
        keys.append(mix(value + U64(n)))
        rows.append(some)
    both = np.concatenate(keys) & U64((1 << bits) - 1) | np.concatenate(rows).astype(U64) << U64(bits)
    both = np.unique(both)
    return both & U64((1 << bits) - 1), (both >> U64(bits)).astype(np.int64)


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit integers."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(buffer: bytes, width: int) -> np.ndarray:
    got = np.frombuffer(buffer, np.uint8).reshape(-1, width)
    out = np.zeros((len(got), 8), np.uint8)
    out[:, :width] = got
    return out.reshape(-1).view(U64)
