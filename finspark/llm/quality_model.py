"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= j) = sigmoid(threshold_j - w . x) with one weight vector for all grades and
ordered thresholds.  ``x`` counts hashed features of the words of a text, per word: the
lower-cased word, its first three and last two bytes, and its shape (kinds of its first,
second and last byte, and whether it repeats the word before), divided by the number of
words.  Weights and thresholds are fitted together by full-batch gradient steps on a
bounded sample of rated rows in one task; the model (2^16 weights) is broadcast.

Scores are the expected grade and the tail probability P(grade >= ``tail``); a text whose
tail probability is at least ``least`` is selected.

Defined cases: a null, empty or wordless text has x = 0 and the score of that; without two
grades in the sample the weights are 0 and the thresholds give the sample's shares (all
grades alike if there are no rows); null grades are not used; repeated rows each return a
row; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.llm.words import U64, find_words, mix, row_sums, slices, span_hashes, word_hashes

FEATURE_BITS, SCALE = 16, 30.0


def _shapes() -> np.ndarray:
    kind = np.full(256, 1, np.int64)
    for i, some in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:?'\"-()", b"!")):
        kind[list(some)] = i + 2
    kind[0x80:] = 7
    return kind


_SHAPE = _shapes()


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, 4 per word; index of each row's first word, with the end)."""
    words = find_words(column)
    if not len(words.start):
        return np.zeros((4, 0), np.int64), words.first
    whole = word_hashes(words, lower=True)
    head = span_hashes(words.data, words.start, np.minimum(words.start + 3, words.end), lower=True)
    tail = span_hashes(words.data, np.maximum(words.end - 2, words.start), words.end)
    again = np.zeros(len(whole), bool)
    again[1:] = (whole[1:] == whole[:-1]) & (words.row[1:] == words.row[:-1])
    second = np.minimum(words.start + 1, words.end - 1)
    shape = again + 2 * (_SHAPE[words.data[words.start]] + 8 * (_SHAPE[words.data[second]] + 8 * _SHAPE[words.data[words.end - 1]]))
    keys = [whole, mix(head + U64(1)), mix(tail + U64(2)), mix(shape.astype(U64) + U64(3 << 40))]
    return np.stack([(k >> U64(64 - FEATURE_BITS)).astype(np.int64) for k in keys]), words.first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _grade_probabilities(z: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros((1, len(z))), _sigmoid(thresholds[:, None] - z), np.ones((1, len(z)))])
    return np.maximum(np.diff(upto, axis=0), 1e-12)


def fit_ordinal(index: np.ndarray, row: np.ndarray, value: np.ndarray, grade: np.ndarray, grades: int,
                steps: int = 200, rate: float = 0.1, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds for sparse rows (feature, row, value), by Adam steps."""
    share = np.cumsum(np.bincount(grade, minlength=grades) + 1.0)[:-1] / (len(grade) + grades)
    start = np.log(share / (1 - share))
    # Thresholds as the first one and the logarithms of the gaps.
    place = np.r_[start[:1], np.log(np.maximum(np.diff(start), 1e-3))]
    w = np.zeros(1 << FEATURE_BITS)
    ordered = lambda p: np.cumsum(np.r_[p[:1], np.exp(p[1:])])
    if len(np.unique(grade)) < 2:
        return w, ordered(place)
    m, v = [np.zeros(len(w)), np.zeros(len(place))], [np.zeros(len(w)), np.zeros(len(place))]
    for step in range(1, steps + 1):
        cuts = ordered(place)
        z = np.bincount(row, value * w[index], len(grade))
        s = np.concatenate([np.zeros((1, len(z))), _sigmoid(cuts[:, None] - z), np.ones((1, len(z)))])
        slope = s * (1 - s)
        at = np.arange(len(grade))
        p = np.maximum(s[grade + 1, at] - s[grade, at], 1e-12)
        dz = (slope[grade + 1, at] - slope[grade, at]) / p / len(grade)
        dcut = np.zeros(grades + 1)
        np.add.at(dcut, grade + 1, -slope[grade + 1, at] / p / len(grade))
        np.add.at(dcut, grade, slope[grade, at] / p / len(grade))
        dcut = dcut[1:-1]
        later = np.cumsum(dcut[::-1])[::-1]
        gradient = [np.bincount(index, value * dz[row], len(w)) + ridge * w, later * np.r_[1.0, np.exp(place[1:])]]
        for i, (x, g) in enumerate(((w, gradient[0]), (place, gradient[1]))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            x -= rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)
    return w, ordered(place)


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, grade, features, values) of the sample: distinct features with their counts per word."""
    for batch in batches:
        for part in slices(batch):
            numbers, first = _features(part.column("text"))
            features, values = [], []
            for i in range(part.num_rows):
                own, times = np.unique(numbers[:, first[i]:first[i + 1]], return_counts=True)
                features.append(own.astype("<u4").tobytes())
                values.append((times * SCALE / max(first[i + 1] - first[i], 1)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("grade"), pa.array(features), pa.array(values)], ["id", "grade", "features", "values"])


def _fit_rows(grades: int):
    """The model of all rows of the one task, put in order of id."""
    def run(batches):
        rows = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: (r[0], r[1]))
        index = [np.frombuffer(r[2], "<u4").astype(np.int64) for r in rows]
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        weights, thresholds = fit_ordinal(
            joined(index, np.int64), np.repeat(np.arange(len(rows)), [len(x) for x in index]),
            joined([np.frombuffer(r[3], "<f4").astype(float) for r in rows], float),
            np.array([r[1] for r in rows], np.int64), grades)
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()]), pa.array([thresholds.tolist()])],
                                         ["weights", "thresholds"])
    return run


def _gathered(sample: DataFrame) -> DataFrame:
    """The sample's features in one task, after a shuffle: reading, joining and features run in all tasks."""
    return sample.mapInArrow(_sample_rows, "id bigint, grade bigint, features binary, values binary").repartition(1)


def learn_quality(rated: DataFrame, grades: int) -> tuple[bytes, list[float]]:
    """(weights, thresholds) from bounded rows of (id, text, grade), grades 0 to ``grades`` - 1."""
    sample = rated.filter("grade is not null").select(F.col("id").cast("bigint"), "text", F.col("grade").cast("bigint"))
    row = _gathered(sample).mapInArrow(_fit_rows(grades), "weights binary, thresholds array<double>").first()
    return bytes(row.weights), list(row.thresholds)


def rated_rows(docs: DataFrame, labels: DataFrame, held_out, max_rows: int = 10_000) -> DataFrame:
    """(id, text, grade) of the first ``max_rows`` labelled rows by md5 of the id, outside the held-out
    part.  Grades: 0 poor, 1 good but toxic, 2 good."""
    chosen = (labels.filter("doc_id is not null and quality is not null").filter(~held_out)
              .select(F.col("doc_id").alias("id"), F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                      .otherwise(2).alias("grade"))
              .orderBy(F.md5(F.col("id").cast("string")), "grade").limit(max_rows))
    return F.broadcast(chosen).join(docs.select(F.col("doc_id").alias("id"), "text"), "id").select("id", "text", "grade")


def _score_rows(model, extra: list[str], tail: int):
    def run(batches):
        weights, thresholds = model.value
        weights, thresholds = np.frombuffer(weights, "<f4"), np.array(thresholds)
        for batch in batches:
            for part in slices(batch):
                numbers, first = _features(part.column("text"))
                z = row_sums(weights[numbers].sum(axis=0, dtype=np.float64), first) * SCALE / np.maximum(np.diff(first), 1)
                p = _grade_probabilities(z, thresholds)
                p /= p.sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in extra), pa.array(np.arange(len(p)) @ p), pa.array(p[tail:].sum(axis=0))],
                    [*extra, "expected_grade", "tail_prob"])
    return run


def score_quality(docs: DataFrame, model: tuple[bytes, list[float]], text_col: str = "text", tail: int = 1,
                  least: float = 0.5) -> DataFrame:
    """``docs`` without its text, with ``expected_grade``, ``tail_prob`` and ``kept``."""
    names = [c for c in docs.columns if c not in (text_col, "expected_grade", "tail_prob", "kept")]
    plain = [f"_{i}" for i in range(len(names))]
    rows = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)), F.col(text_col).alias("text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    scored = rows.mapInArrow(_score_rows(docs.sparkSession.sparkContext.broadcast(model), plain, tail),
                             kinds + ", expected_grade double, tail_prob double")
    return scored.withColumn("kept", F.col("tail_prob") >= least).toDF(*names, "expected_grade", "tail_prob", "kept")
