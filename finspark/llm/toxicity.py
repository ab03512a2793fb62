"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, takes compatibility forms apart (NFKD: accents of any kind, full-width,
mathematical and circled letters), drops combining marks and invisible characters, maps
look-alike letters of other scripts to Latin, and reads digits and signs as the letters
they stand in for (one shape for l, i and 1).  Everything else separates words.

The lexicon is learnt from a bounded sample of labelled rows: whole words and word stems,
weighted by their smoothed log odds between toxic and other texts, counted by Spark once
per text.  Every entry is kept that occurs in three toxic texts or more, at odds of ``min_odds``, and
whose excess in toxic texts is no chance (a likelihood ratio of ``min_ratio``, which asks the same of a
sample of any size); the sample bounds their number.  Word pairs around an entry that occur in clean texts at least as often as in
toxic ones are learnt as exception phrases, beside those given; a match inside an
exception does not count.  A text's value is the sum of its matches' weights divided by
the square root of its words (plus a constant); a logistic curve fitted on the sample
turns it into a score from 0 to 1.

Defined cases: null, empty and wordless texts have value 0 and the score of that value;
without a labelled row of each kind the lexicon is empty and every score is the base rate
(0 if there are no labels at all); null labels are not used; repeated rows each return a
row; long texts are read whole; other columns are ignored.  Ties in the bounded sample
are broken by id.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finspark.llm.scratch import written

# Look-alikes of Latin letters (Cyrillic, Greek), and characters used for letters.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "l": "i"}
INVISIBLE = "­​‌‍⁠﻿"


def _folding() -> dict[int, str | None]:
    """Lower-cased characters to folded ones; other signs become a space."""
    table: dict[int, str | None] = {}
    for code in [*range(0x80), *range(0xC0, 0x250), *range(0xFF01, 0xFF5F)]:
        base = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if base.isascii():
            table[code] = base if base.isalnum() or base in SUBSTITUTES else " "
        elif chr(code) in LOOK_ALIKES:
            table[code] = LOOK_ALIKES[chr(code)]
    table |= {ord(k): v for k, v in LOOK_ALIKES.items()} | {ord(c): None for c in INVISIBLE}
    table |= {c: " " for c in [*range(0xA0, 0xC0), *range(0x2000, 0x2070)] if chr(c) not in INVISIBLE}
    # Combining marks, which NFKD splits off.
    table |= {c: None for lo, hi in ((0x300, 0x370), (0x1AB0, 0x1B00), (0x1DC0, 0x1E00), (0x20D0, 0x2100), (0xFE20, 0xFE30))
              for c in range(lo, hi)}
    return {k: SUBSTITUTES.get(v, v) if v else v for k, v in table.items()}


_FOLD = _folding()
_INNER = re.compile(r"(?<=\w)[!|](?=\w)")


def fold(text: str | None) -> str:
    """Folded words with one space around each; ``" "`` if there are none."""
    text = (text or "").lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text).lower()
    if "!" in text or "|" in text:
        text = _INNER.sub("i", text)
    return " ".join(["", *text.translate(_FOLD).split(), ""]) or " "


@dataclass(frozen=True)
class Lexicon:
    """Entries begin with a space; whole words end with one, stems do not."""

    weights: dict[str, float]
    exceptions: frozenset[str]
    slope: float = 0.0
    base: float = -20.0

    def value(self, automaton: ahocorasick.Automaton, text: str) -> float:
        """Sum of match weights over the square root of the length; one match per word."""
        best: dict[int, float] = {}
        covered: list[tuple[int, int]] = []
        for end, (entry, weight) in automaton.iter(text):
            start = end - len(entry) + 1
            if weight is None:
                covered.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if covered:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in covered)}
        return sum(best.values()) / (text.count(" ") + 19) ** 0.5 if best else 0.0

    def automaton(self) -> ahocorasick.Automaton:
        made = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            made.add_word(entry, (entry, weight))
        for phrase in self.exceptions:
            made.add_word(phrase, (phrase, None))
        made.add_word("\0", ("\0", 0.0))
        made.make_automaton()
        return made


def held_out(id_col: str = "doc_id") -> Column:
    """A fifth of all ids, never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def _entries(text: str, stems: Sequence[int]) -> set[str]:
    words = set(text.split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in stems if len(w) > n}


def _count_rows(stems: Sequence[int]):
    """(entry, texts with it, toxic texts with it), summed per batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                own = _entries(fold(text.as_py()), stems)
                counts[0].update(own)
                if toxic.as_py():
                    counts[1].update(own)
            keys = list(counts[0])
            for at in range(0, len(keys), 50_000):
                some = keys[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), *(pa.array([c[k] for k in some], pa.int64()) for c in counts)], ["entry", "n", "toxic"])
    return run


def _pair_rows(lexicon: Lexicon):
    """(pair, 1, toxic) of the word pairs around each matched word, once per text."""
    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            pairs, labels = [], []
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                text, own = fold(text.as_py()), set()
                for end, (entry, _) in automaton.iter(text):
                    start = end - len(entry) + 1
                    stop = text.find(" ", start + 1)
                    before, after = text.rfind(" ", 0, start) if start else -1, text.find(" ", stop + 1)
                    own |= ({text[before:stop + 1]} if before >= 0 else set()) | ({text[start:after + 1]} if after > 0 else set())
                pairs += own
                labels += [toxic.as_py()] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.string()), pa.array([1] * len(pairs), pa.int64()),
                                              pa.array(labels, pa.int64())], ["entry", "n", "toxic"])
    return run


def _value_rows(lexicon: Lexicon, extra: Sequence[str], source: str = "text"):
    def run(batches):
        automaton = lexicon.automaton()
        for batch in batches:
            values = [lexicon.value(automaton, fold(x.as_py())) for x in batch.column(source)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in extra), pa.array(values, pa.float64())],
                                             [*extra, "value"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and base of a logistic curve of one variable (Newton, a small ridge on the slope)."""
    design, beta = np.stack([x, np.ones(len(x))]), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(beta @ design, -30, 30)))
        step = np.linalg.solve(design * (p * (1 - p)) @ design.T + np.diag([ridge, 1e-9]) * len(x) / 1000 + 1e-9 * np.eye(2),
                               design @ (y - p) - np.array([ridge * len(x) / 1000 * beta[0], 0]))
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def likelihood_ratio(hits: Column, of: Column, rate: float) -> Column:
    """G squared of ``hits`` among ``of`` texts where a share ``rate`` is expected."""
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    return 2 * (part(hits, of * rate) + part(of - hits, of * (1 - rate)))


def learn_lexicon(labelled: DataFrame, min_odds: float = 4.0, min_ratio: float = 24.0, least: int = 3,
                  stems: Sequence[int] = (4, 5, 6), exceptions: Sequence[str] = ()) -> Lexicon:
    """A lexicon from bounded rows of (id, text, toxic), one of each text."""
    given = frozenset(fold(x) for x in exceptions)
    sample = written(labelled.filter("toxic is not null").groupBy(F.md5(F.coalesce("text", F.lit(""))).alias("same"))
                     .agg(F.min_by(F.struct("id", "text", "toxic"), "id").alias("row")).select("row.*"), "sample")
    totals = sample.agg(F.count("*"), F.sum(F.col("toxic").cast("bigint"))).first()
    n, bad = totals[0], totals[1] or 0
    if not bad or bad == n:
        return Lexicon({}, given, 0.0, -20.0 if not n or not bad else 20.0)
    odds = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("all") - F.col("bad") + 0.5) / (n - bad + 1.0))
    counted = (sample.repartition(sample.sparkSession.sparkContext.defaultParallelism).select("text", "toxic")
               .mapInArrow(_count_rows(stems), "entry string, n bigint, toxic bigint")
               .groupBy("entry").agg(F.sum("n").alias("all"), F.sum("toxic").alias("bad")))
    best = (counted.filter(F.col("bad") >= least).withColumn("odds", odds).filter(F.col("odds") >= min_odds)
            .filter(likelihood_ratio(F.col("bad"), F.col("all"), bad / n) >= min_ratio).select("entry", "odds").collect())
    weights: dict[str, float] = {}
    for row in sorted(best, key=lambda r: (len(r.entry.rstrip()), r.entry)):
        stem = row.entry.rstrip()
        if not any(weights.get(stem[:i], 0.0) >= row.odds - 0.7 for i in range(2, len(stem) + (row.entry != stem))):
            weights[row.entry] = row.odds
    lexicon = Lexicon(weights, given)
    mild = (sample.select("text", "toxic").mapInArrow(_pair_rows(lexicon), "entry string, n bigint, toxic bigint")
            .groupBy("entry").agg(F.sum("n").alias("all"), F.sum("toxic").alias("bad"))
            .filter((F.col("all") >= least) & (F.col("bad") * n <= F.col("all") * bad))
            .select("entry").collect())
    lexicon = Lexicon(weights, given | {r.entry for r in mild})
    pairs = sample.select("text", "toxic").mapInArrow(_value_rows(lexicon, ["toxic"]), "toxic int, value double").collect()
    slope, base = _logistic(np.array([p.value for p in pairs]), np.array([float(p.toxic) for p in pairs]))
    return Lexicon(lexicon.weights, lexicon.exceptions, slope, base)


def labelled_rows(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """(id, text, toxic) of the first ``max_rows`` labelled rows, by md5 of the id, outside the held-out fifth."""
    chosen = (labels.filter("toxic is not null and doc_id is not null").filter(~held_out())
              .select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
              .orderBy(F.md5(F.col("id").cast("string")), "toxic").limit(max_rows))
    return F.broadcast(chosen).join(docs.select(F.col("doc_id").alias("id"), "text"), "id").select("id", "text", "toxic")


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs``, with or without its text, with ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    names = [c for c in docs.columns if c not in ("score", "predicted") and (keep_text or c != text_col)]
    plain = [f"_{i}" for i in range(len(names))]
    rows = docs.select(*(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)),
                       *([] if keep_text else [F.col(text_col).alias("text")]))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    source = plain[names.index(text_col)] if keep_text else "text"
    valued = rows.mapInArrow(_value_rows(lexicon, plain, source), kinds + ", value double")
    score = 1 / (1 + F.exp(-(F.col("value") * lexicon.slope + lexicon.base)))
    return valued.select(*plain, score.alias("score"), F.when(score >= 0.5, 1).otherwise(0).alias("predicted")).toDF(
        *names, "score", "predicted")
