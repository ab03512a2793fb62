"""Benchmark decontamination: item-sized windows, met by the items' rarest shingles.

A document holds a benchmark item when one of its windows of as many ``k``-word shingles
as the item has (all of them, if it has fewer) is similar to the item: the sum of smaller
counts over the sum of larger counts of all shingles is at least ``percent`` percent.

1. Windows.  A window without any shingle of an item has similarity 0, and of the windows
   with an item's shingles a best one begins with such a shingle or ends with the text
   (moving its start up to the next common shingle loses none).  Only these windows are
   formed, for the sizes of the items whose shingles they meet.
2. Index.  A pair at the threshold shares at least ``percent`` percent of the item's shingles,
   repeats counted.  So of any choice of one shingle more than the rest of the item's, the
   window has one: an item is entered under its rarest shingles (by items that have them), and
   a window looks up all of its own.  Every pair meets, whatever the data.
3. Pairs that meet are verified by their exact weighted similarity.

Windows are found by joining shingles with the benchmark's; that table is broadcast only
if its rows were counted and are few, and shuffled otherwise.  DataFrame functions only.

Defined cases: null, empty and wordless texts and items hold and match nothing; fewer
than ``k`` words are one shingle; null ids of documents or items are left out; repeated
rows of a document id count as several texts, of which the best window is reported, and repeated
rows of an item count once (item ids name one text each); very long texts are read whole;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finspark.llm.scratch import written
from finspark.llm.shingles_sql import shingles_column, words_column

#: Benchmark shingles broadcast at most (16 bytes each).
BROADCAST_ROWS = 1_000_000


def _counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, shingle, times) of the shingle arrays of distinct keys."""
    return rows.select(key, F.explode("shingles").alias("h")).groupBy(key, "h").agg(F.count("*").alias("times"))


def _rarest(bench: DataFrame, percent: int) -> DataFrame:
    """(item, length, h): shingles of each item, rarest first, until the others are fewer than a held item shares."""
    counts = _counts(bench, "item").join(bench.select("item", "length").distinct(), "item")
    counts = counts.join(counts.groupBy("h").agg(F.count("*").alias("items")), "h")
    ahead = Window.partitionBy("item").orderBy("items", "h").rowsBetween(Window.unboundedPreceding, -1)
    spare = F.floor(F.col("length") * (100 - percent) / 100)
    return (counts.withColumn("before", F.coalesce(F.sum("times").over(ahead), F.lit(0)))
            .filter(F.col("before") <= spare).select("item", "length", "h"))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """``(id, item, common, total)`` for every document and item it holds, of the best window:
    similarity is ``common / total`` (sums of smaller and larger shingle counts)."""
    shingled = lambda t: shingles_column(words_column(F.col(t)), k)
    bench = written(items.filter(F.col(item_col).isNotNull()).select(
        F.col(item_col).alias("item"), shingled(item_text_col).alias("shingles")).distinct()
        .filter(F.size("shingles") > 0).withColumn("length", F.size("shingles")), "items")
    vocabulary = bench.select(F.explode("shingles").alias("h"), "length").groupBy("h").agg(
        F.collect_set("length").alias("lengths"))
    if (bench.agg(F.sum("length")).first()[0] or 0) <= BROADCAST_ROWS:
        vocabulary = F.broadcast(vocabulary)

    texts = docs.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))
    met = (texts.select("id", "text_key", F.posexplode(shingled("text")).alias("start", "h"))
           .join(vocabulary, "h").select("id", "text_key", "start", "lengths"))
    starts = met.groupBy("id", "text_key").agg(F.collect_set(F.struct("start", "lengths")).alias("starts"))
    # Windows of the texts that have any, one row for each start and size.
    windows = (texts.join(starts, ["id", "text_key"]).distinct()
               .select("id", "text_key", shingled("text").alias("all"), "starts")
               .select("id", "text_key", "all", F.explode("starts").alias("s"))
               .select("id", "text_key", "all", "s.start", F.explode("s.lengths").alias("length")))
    last = F.greatest(F.size("all") - F.col("length"), F.lit(0))
    windows = windows.select(
        "id", "length", F.slice("all", F.least(F.col("start"), last) + 1, F.col("length")).alias("shingles"))
    windows = written(windows.withColumn("window", F.xxhash64("length", "shingles")), "windows")
    # Equal windows, such as those of one passage in many documents, are looked up once.
    contents = written(windows.select("window", "length", "shingles").distinct(), "contents")

    near = (contents.select("window", "length", F.explode(F.array_distinct("shingles")).alias("h"))
            .join(_rarest(bench, percent), ["h", "length"]).select("window", "item").distinct())
    pairs = near.join(contents.select("window", F.size("shingles").alias("n")), "window").join(
        bench.select("item", "length").distinct(), "item")
    common = (pairs.join(_counts(contents, "window"), "window")
              .join(_counts(bench, "item").withColumnRenamed("times", "wanted"), ["item", "h"])
              .groupBy("item", "window", "n", "length").agg(F.sum(F.least("times", "wanted")).alias("common")))
    held = common.withColumn("total", F.col("n") + F.col("length") - F.col("common")).filter(
        F.col("common") * 100 >= F.col("total") * percent)
    held = held.join(windows.select("window", "id").distinct(), "window")
    return held.groupBy("id", "item").agg(F.max(F.struct(
        (F.col("common") / F.col("total")).alias("similarity"), "common", "total")).alias("best")).select(
        "id", "item", "best.common", "best.total")
