"""Words and word shingles as array columns, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spark (Java) pattern between words.
GAP = r"[\x20\x09-\x0D]+"


def words_column(text: Column) -> Column:
    """The words of a text, lower-cased; empty for null and empty texts."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), GAP), "")


def shingles_column(words: Column, k: int) -> Column:
    """Hashes of the ``k``-word shingles in order, repeats kept; fewer words are one shingle."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = lambda h: F.transform(
        F.sequence(F.lit(1), F.size(h) - (k - 1)), lambda i: F.xxhash64(*(F.element_at(h, i + j) for j in range(k))))
    whole = lambda h: F.array(F.xxhash64(h))
    # The array of word hashes is bound once, by a transform over a single-element array.
    bound = F.transform(F.array(hashes), lambda h: F.when(F.size(h) >= k, grams(h))
                        .when(F.size(h) > 0, whole(h)).otherwise(F.array().cast("array<bigint>")))
    return F.element_at(bound, 1)
