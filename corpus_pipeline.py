"""Training-corpus pipeline over ``documents``: five stages of the training-data operators.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but
the last return the columns of ``docs``.  Ids to drop are counted: few are broadcast, more
are joined by shuffle.  Rows with a null id pass the stages that judge by id.  Columns that no
stage reads pass through, whatever their names (the results of mixing win over columns of
their names, as that operator says).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.llm.decontaminate import contaminated
from finspark.llm.mixture import mix_sources
from finspark.llm.ngram_join import jaccard_components
from finspark.llm.scratch import if_small, written
from finspark.llm.substring_dedup import remove_repeats
from finspark.llm.toxicity import labelled_rows, learn_lexicon, score_toxicity
from finspark.sources.tables import read_table


#: Columns that the stages read.
_READ = ("doc_id", "text", "lang", "source", "n_chars")


def _keeps_columns(stage: Callable) -> Callable:
    """A filtering stage over columns whose names cannot clash with those of its operator."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = [c if c in _READ else f"__{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inner), sf_dir).select(*inner).toDF(*docs.columns)
    return run


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    gone = if_small(ids.toDF("gone"))
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


@_keeps_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the lexicon is learnt from their labelled rows."""
    lexicon = learn_lexicon(labelled_rows(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"])))
    return score_toxicity(docs, lexicon, keep_text=True).filter("predicted = 0").select(*docs.columns)


@_keeps_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each Jaccard component stays."""
    return _without(docs, jaccard_components(docs).filter("component <> id").select("id"))


@_keeps_columns
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that a smaller id has go; then the others stand with one space
    between.  A text that loses nothing stays as it is; one that loses everything goes."""
    cut = remove_repeats(docs).filter("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changes = {"text": text}
    if "n_chars" in docs.columns:
        changes["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(
            F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumns(changes).select(*docs.columns)


@_keeps_columns
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return _without(docs, contaminated(docs, read_table(spark, sf_dir, "benchmark")).select("id").distinct())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their takings and training positions, sorted by position."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix),
]

#: The learnt lexicon is not expressible in SQL; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
