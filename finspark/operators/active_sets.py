"""Exact distinct customers as mergeable bitmaps, stored per month.

Every customer gets a dense number when first seen active; a month's active customers are bitmaps
over these numbers (32,768 customers a row), split by cohort.  A new month is added from that month's
facts alone; retention reads stored counts, and distinct customers over any span of months are the
union (``bitmap_or_agg``) of its months' bitmaps, with no look at the facts again.

A store is a folder of numbered loads, each with ``customers`` (customer_id, number, cohort_month) for
customers it saw first and ``sets`` (cohort_month, activity_month, bucket, bitmap).  ``sets`` is written
last: a load without it did not happen, and the next load takes its place.  Loads go forward in
time, since an earlier month could change the cohorts already stored; one that does not is an error.

Defined cases: rows without customer or time are left out; repeated rows count once; a load without
rows adds nothing; columns other than the customer's and the time are ignored.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from finspark.functions.dates import month_boundaries_between, month_start
from finspark.functions.numeric import safe_ratio
from finspark.operators.gold import success_transactions
from finspark.operators.ingest import scratch_dir
from finspark.plans.registry import pipeline, query, round_columns

CUSTOMERS = "customer_id string, number bigint, cohort_month date"
SETS = "cohort_month date, activity_month date, bucket bigint, bitmap binary"
#: Bits of monotonically_increasing_id that number the rows of a partition.
_ROW_BITS = 33


class ActiveSets:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _exists(self, path: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def loads(self) -> int:
        """The number of finished loads."""
        n = 0
        while self._exists(f"{self.root}/load={n}/sets/_SUCCESS"):
            n += 1
        return n

    def _read(self, name: str, schema: str, loads: int) -> DataFrame:
        paths = [f"{self.root}/load={n}/{name}" for n in range(loads)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def customers(self) -> DataFrame:
        return self._read("customers", CUSTOMERS, self.loads())

    def sets(self) -> DataFrame:
        return self._read("sets", SETS, self.loads())

    def add(self, facts: DataFrame, since: dt.date | None, until: dt.date | None,
            customer: str = "customer_id", time: str = "created_at") -> None:
        """Add the months from ``since`` up to, not including, ``until`` (first days of months; None: open).
        The bounds reach the scan of ``facts``, so only these months are read."""
        if any(d is not None and d.day != 1 for d in (since, until)):
            raise ValueError("a load begins and ends at the first day of a month")
        done = self.loads()
        last = self._read("sets", SETS, done).agg(F.max("activity_month")).first()[0]
        if last is not None and (since is None or since <= last):
            raise ValueError(f"months up to {last} are stored; a load from {since} would change them")
        for bound, inside in ((since, F.col(time).__ge__), (until, F.col(time).__lt__)):
            if bound is not None:
                facts = facts.where(inside(F.lit(bound)))
        folder = f"{self.root}/load={done}"
        active = self._stored(f"{folder}/active", facts.where(F.col(customer).isNotNull() & F.col(time).isNotNull()).select(
            F.col(customer).cast("string").alias("customer_id"), month_start(time).alias("activity_month")).distinct())
        self._number(active, folder, done)
        known = self._read("customers", CUSTOMERS, done + 1)
        bits = active.join(known, "customer_id").groupBy(
            "cohort_month", "activity_month", F.bitmap_bucket_number("number").alias("bucket"))
        bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")).write.mode("overwrite").parquet(f"{folder}/sets")

    def _stored(self, path: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _number(self, active: DataFrame, folder: str, done: int) -> None:
        """Write the load's new customers with the numbers that follow the stored ones.  A partition's rows are
        numbered where they lie; only the partitions' row counts are summed in order."""
        known = self._read("customers", CUSTOMERS, done)
        base = known.agg(F.max("number")).first()[0] or 0
        fresh = active.groupBy("customer_id").agg(F.min("activity_month").alias("cohort_month")).join(
            known.select("customer_id"), "customer_id", "left_anti")
        placed = self._stored(f"{folder}/placed", fresh.withColumn("at", F.monotonically_increasing_id()))
        part = F.shiftright("at", _ROW_BITS)
        sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
        before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
        number = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.lit(base + 1)
        (placed.withColumn("part", part).join(F.broadcast(before), "part")
         .select("customer_id", number.alias("number"), "cohort_month").write.mode("overwrite").parquet(f"{folder}/customers"))

    def retention(self) -> DataFrame:
        """(cohort_month, months_since_cohort, customers_in_cohort, customers_retained, retention_rate)."""
        kept = self.sets().groupBy("cohort_month", "activity_month").agg(F.sum(F.bitmap_count("bitmap")).alias("customers_retained"))
        since = month_boundaries_between("cohort_month", "activity_month")
        size = F.sum(F.when(F.col("months_since_cohort") == 0, F.col("customers_retained"))).over(Window.partitionBy("cohort_month"))
        return (kept.withColumn("months_since_cohort", since).withColumn("customers_in_cohort", size)
                .select("cohort_month", "months_since_cohort", "customers_in_cohort", "customers_retained",
                        safe_ratio("customers_retained", "customers_in_cohort").alias("retention_rate")))

    def distinct_per(self, span: Column, sets: DataFrame | None = None) -> DataFrame:
        """(span, active_customers): exact distinct customers of each value of ``span`` (of the sets' columns)."""
        merged = (self.sets() if sets is None else sets).groupBy(span.alias("span"), "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        return merged.groupBy("span").agg(F.sum(F.bitmap_count("bitmap")).alias("active_customers"))

    def distinct_trailing(self, months: int) -> DataFrame:
        """(span, active_customers): per stored month, the distinct customers of the ``months`` up to it.
        A month's bitmaps are merged over cohorts first, then go to each of the months they count for."""
        monthly = self.sets().groupBy("activity_month", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        reach = F.sequence("activity_month", F.add_months("activity_month", months - 1), F.expr("interval 1 month"))
        stored = self.sets().select(F.col("activity_month").alias("month")).distinct()
        spread = monthly.select(F.explode(reach).alias("month"), "bucket", "bitmap").join(F.broadcast(stored), "month")
        return self.distinct_per(F.col("month"), spread)


#: The registered queries load up to here, from here up to there, and the rest.
LOAD_BOUNDS = (dt.date(1995, 1, 1), dt.date(1997, 1, 1))


def loaded_sets(spark: SparkSession, sf_dir: str) -> ActiveSets:
    """The successful transactions in three loads, each merged with what the loads before it stored."""
    store = ActiveSets(spark, scratch_dir(spark, "active-sets"))
    facts = success_transactions(pipeline(spark, sf_dir)).select("customer_id", "created_at")
    for since, until in zip((None, *LOAD_BOUNDS), (*LOAD_BOUNDS, None)):
        store.add(facts, since, until)
    return store


@query("active_sets_retention")
def active_sets_retention_q(spark, sf_dir):
    return round_columns(loaded_sets(spark, sf_dir).retention(), {"retention_rate": 6})


@query("active_sets_distinct")
def active_sets_distinct_q(spark, sf_dir):
    """Distinct active customers per quarter, per year, and in the twelve months up to each month."""
    store = loaded_sets(spark, sf_dir)
    parts = {"quarter": store.distinct_per(F.trunc("activity_month", "quarter")),
             "year": store.distinct_per(F.trunc("activity_month", "year")), "12 months": store.distinct_trailing(12)}
    return reduce(DataFrame.unionByName, (df.select(F.lit(k).alias("kind"), F.col("span").alias("month"), "active_customers")
                                          for k, df in parts.items()))
