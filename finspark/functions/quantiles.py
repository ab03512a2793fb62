"""Exact quantiles of whole numbers per group, by selection instead of sorting.

Every pass cuts the range that holds a wanted rank into ``BINS`` and counts rows per bin; the bin
that holds the rank is the next range, until it is one value.  Counts are combined before the
shuffle, so a pass ships at most ``BINS`` rows per task and wanted rank: no group's values meet in a task,
and the result is the order statistic itself.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 1024


def order_statistics(df: DataFrame, group: str, value: str, ranks: DataFrame,
                     cut: Callable[[DataFrame], DataFrame] = lambda x: x, bins: int = BINS) -> DataFrame:
    """(group, rank, value) of ``ranks`` (group, rank from 0, lo, hi): the range of the group's values.

    ``value`` is bigint without NULLs.  ``ranks`` has a few rows per group; ``cut`` ends the lineage of what a
    pass leaves (a checkpoint)."""
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v"))
    state = cut(ranks.select(F.col(group).alias("g"), "rank", "lo", "hi", F.lit(0).cast("bigint").alias("below")))
    while True:
        span = state.agg(F.max(F.col("hi") - F.col("lo")).alias("span")).first()["span"]
        if not span:  # every range is one value, or there is none
            return state.select(F.col("g").alias(group), "rank", F.col("lo").alias(value))
        width = span // bins + 1
        met = (rows.join(F.broadcast(state.withColumnRenamed("g", "of")), F.col("g").eqNullSafe(F.col("of"))).where(F.col("v").between(F.col("lo"), F.col("hi")))
               .groupBy("g", "rank", "lo", "hi", "below", F.expr(f"(v - lo) div {width}").alias("bin"))
               .agg(F.count(F.lit(1)).alias("n")))
        upto = Window.partitionBy("g", "rank").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        passed = met.withColumn("upto", F.col("below") + F.sum("n").over(upto))
        held = passed.where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
        low = F.col("lo") + F.col("bin") * width
        state = cut(held.select("g", "rank", low.alias("lo"), F.least("hi", low + (width - 1)).alias("hi"),
                                (F.col("upto") - F.col("n")).alias("below")))


def quantiles(df: DataFrame, group: str, value: str, probabilities: dict[str, float],
              cut: Callable[[DataFrame], DataFrame] = lambda x: x, bins: int = BINS) -> DataFrame:
    """(group, one column per name): quantiles of a whole-number column, interpolated between the two order
    statistics around ``p * (n - 1)``.  NULL values do not count."""
    df = df.where(F.col(value).isNotNull())
    facts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))
    places = F.array(*[F.struct(F.lit(name).alias("name"), (F.lit(p) * (F.col("n") - 1)).alias("place"))
                       for name, p in probabilities.items()])
    wanted = cut(facts.select(group, "lo", "hi", F.explode(places).alias("w")).select(
        group, "lo", "hi", "w.name", "w.place", F.floor("w.place").alias("low"), F.ceil("w.place").alias("high")))
    ranks = wanted.select(group, F.col("low").alias("rank"), "lo", "hi").union(
        wanted.select(group, F.col("high").alias("rank"), "lo", "hi")).distinct()
    found = order_statistics(df, group, value, ranks, cut, bins)
    at = lambda c, v: found.select(F.col(group).alias("_g"), F.col("rank").alias(c), F.col(value).cast("double").alias(v))
    both = wanted.join(at("_low", "a"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("low") == F.col("_low"))).drop("_g", "_low")
    both = both.join(at("_high", "b"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("high") == F.col("_high"))).drop("_g", "_high")
    between = F.col("a") + (F.col("b") - F.col("a")) * (F.col("place") - F.col("low"))
    return both.groupBy(group).agg(*[F.max(F.when(F.col("name") == n, between)).alias(n) for n in probabilities])
