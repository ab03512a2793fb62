"""Mixing sources to target weights: a time-varying curriculum.

Each source has a weight and a schedule, its relative density over training time 0..1
(values at equally spaced times, linear in between).  Targets come from the weights:
sources share all words by weight, none gets more than ``max_repeats`` times its size,
and what is above is shared again by weight.  A source's documents form a stream in the
order of ``md5(id)`` (then size, then a hash of the text): whole passes, then a part of one, cut where the stream comes
nearest to the target.  The schedule, integrated, is the share of the target demanded up
to a time; inverted at a document's place in the stream it is the document's training
position.  Rows are range-sorted by position (those not taken follow, by md5).

Running sums never run over a whole source: sums of 4,096 slices of the md5 order give
each slice its start, and only the rows of one slice are ordered together, so a source
that holds a third of all rows is spread over 4,096 keys.  Only one row per source is
ever brought into one task.  DataFrame functions only.

Defined cases: null and empty texts have size 0, are never needed by a target, but are
taken with the whole passes of their source at no cost; null sources are one source, the
last; null ids order as the empty string, after it; rows of equal id order by size, then by a
64-bit hash of the text, and rows equal in all these may change places, which changes no
row's result; repeated rows are taken one by one; an empty table gives an empty result.  Other columns pass through, but for the names of the result
columns (``RESULT``), which win.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Spark (Java) pattern of a word.
WORD = r"[^\x20\x09-\x0D]+"
RESULT = ("size", "source_size", "target", "taken", "positions", "position")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """``(source, source_size, place, target)`` from ``(source, source_size)``, one row per source.

    With the sources in order of (limit / weight) those at their limit come first: a source
    is at its limit if an equal share of what the ones before leave would reach it."""
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.asc_nulls_last("source"))
    limit = F.col("source_size") * max_repeats
    before = everything.orderBy((limit / F.col("weight")).asc(), F.asc_nulls_last("source")).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1))
    ranked = ranked.select(
        "*", limit.alias("limit"),
        (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weights"))
    full = ranked.withColumn("full", F.col("limit") * F.col("weights") <= F.col("left") * F.col("weight"))
    free = F.when(~F.col("full"), F.col("left") / F.col("weights"))
    # The first free source in that order has the share per weight of all free ones.
    share = F.max_by(free, F.when(~F.col("full"), F.col("weights"))).over(everything)
    return full.select("source", "source_size", "place", F.when(F.col("full"), F.col("limit").cast("double"))
                       .otherwise(share * F.col("weight")).alias("target"))


def _inverse(share: Column, schedule: Sequence[float]) -> Column:
    """The time up to which a schedule has used ``share`` of its integral."""
    step = 1.0 / (len(schedule) - 1)
    areas = [(a + b) / 2 * step for a, b in zip(schedule, schedule[1:])]
    out, done, total = None, 0.0, sum(areas)
    pieces = []
    for i, (a, b, area) in enumerate(zip(schedule, schedule[1:], areas)):
        if area > 0:
            rest = share * total - done
            slope = (b - a) / step
            root = F.sqrt(F.greatest(F.lit(a * a) + rest * (2 * slope), F.lit(0.0)))
            pieces.append(((done + area) / total, rest * 2 / (root + a) + i * step))
        done += area
    for top, time in reversed(pieces):
        out = time if out is None else F.when(share < top, time).otherwise(out)
    return F.least(out, F.lit(1.0))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[int] = (1, 2, 3), max_repeats: int = 3,
                schedules: Sequence[Sequence[float]] = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5)),
                keep_text: bool = True) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` (words, repeats counted),
    ``positions`` (one per taking, ascending) and ``position`` (the first), sorted by position."""
    names = [c for c in docs.columns if c not in RESULT and (keep_text or c != text_col)]
    plain = [f"_{i}" for i in range(len(names))]
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        *(F.col(f"`{c}`").alias(p) for c, p in zip(names, plain)), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), order.alias("order"), order.substr(1, 3).alias("slice"),
        F.col(id_col).isNull().alias("no_id"), F.xxhash64(text_col).alias("text_hash"))
    ties = ["order", "no_id", "size", "text_hash"]

    slices = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    targets = source_targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")), weights, max_repeats)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = slices.withColumn("start", F.coalesce(F.sum("slice_size").over(earlier), F.lit(0))).alias("s").join(
        targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source"))).select(
        F.col("s.source").alias("of"), F.col("slice").alias("in"), "start", "source_size", "place", "target")

    within = Window.partitionBy("source", "slice").orderBy(*ties).rowsBetween(Window.unboundedPreceding, -1)
    placed = (rows.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("slice") == F.col("in")))
              .withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(within), F.lit(0)))
              .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                          .otherwise(0))
              .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
              .withColumn("times", F.col("passes") + F.when(F.col("at") + F.col("size") / 2.0 < F.col("rest"), 1)
                          .otherwise(0)))
    each = []
    for i in range(max_repeats):
        share = F.try_divide(F.col("source_size") * i + F.col("at"), F.col("target"))
        time = None
        for j, schedule in enumerate(schedules):
            own = _inverse(share, schedule)
            time = own if time is None else F.when(F.col("place") % len(schedules) == j, own).otherwise(time)
        each.append(F.when(F.col("times") > i, time))
    positions = F.array_compact(F.array(*each))
    out = placed.select(*plain, "order", "no_id", "text_hash", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"),
                        positions.alias("positions")).withColumn("position", F.try_element_at("positions", F.lit(1)))
    by = F.asc_nulls_last("position"), *ties
    return out.repartitionByRange(*by).sortWithinPartitions(*by).drop("order", "no_id", "text_hash").toDF(*names, *RESULT)


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per taking of a document, sorted by training position."""
    rows = mixed.drop("position").withColumn("position", F.explode("positions")).drop("positions")
    return rows.repartitionByRange("position").sortWithinPartitions("position")
