"""The latest row per key over a stream, kept in state that the watermark bounds.

The batch macro (``dedupe_latest``) ranks a whole table; here each key's best row of each window of
event time is state, merged over batches, and given up once the watermark has passed the window's
end.  A batch hands on the rows it improved (update mode); a reader ranks these few per key.

Defined cases: rows that come more than ``delay`` behind the newest event time seen in earlier batches
may be dropped, as the watermark says; repeated rows and ties give one row by the whole ordering;
nulls in the ordering come last, a null key is a key; rows without event time have no window and
pass through without state; columns named ``_at`` and ``_row`` are reserved.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from finspark.operators.macros import dedupe_latest, desc_last
from finspark.operators.silver import DEDUPE_ORDER


def latest_in_state(rows: DataFrame, key: str, order: list[str], event_time: str, delay: str, window: str = "1 day") -> DataFrame:
    """Per key and window of event time the first row by ``order`` (descending, nulls last)."""
    best = F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("_row")
    timed = rows.where(F.col(event_time).isNotNull()).withColumn("_at", F.col(event_time).cast("timestamp_ltz"))
    return timed.withWatermark("_at", delay).groupBy(F.window("_at", window), key).agg(best).select("_row.*")


def _drain(rows: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """All that has landed; a batch replayed after a failure overwrites its own folder."""
    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

    q = (rows.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def stream_latest(spark: SparkSession, landing: str, schema: StructType, root: str, key: str, order: list[str], event_time: str,
                  delay: str) -> StreamingQuery:
    """Drain the Parquet files that landed since the last run; returns the ended query with state."""
    source = lambda: spark.readStream.schema(schema).parquet(landing)
    _drain(source().where(F.col(event_time).isNull()), f"{root}/improved/kind=untimed", f"{root}/_untimed")
    return _drain(latest_in_state(source(), key, order, event_time, delay), f"{root}/improved/kind=timed", f"{root}/_timed")


def read_latest(spark: SparkSession, schema: StructType, root: str, key: str, order: list[str]) -> DataFrame:
    """One row per key: the best of the rows the batches handed on."""
    improved = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/improved")
    return dedupe_latest(improved, key, desc_last(*order))


#: Three landings by the day a row arrives, up to 19 days late, and the watermark that allows for it.
ARRIVALS = (dt.date(1994, 7, 1), dt.date(1996, 7, 1))
MOST_LATE, DELAY = 20, "30 days"


def stream_latest_demo(spark: SparkSession, raw: DataFrame, root: str) -> DataFrame:
    """Raw transactions in three landings with late rows, and with every tenth key's rows sent again one landing later."""
    arrival = F.date_add("ingestion_date", F.pmod(F.xxhash64("transaction_id"), F.lit(MOST_LATE)).cast("int"))
    landing = F.coalesce(sum((arrival >= F.lit(d)).cast("int") for d in ARRIVALS), F.lit(0))
    again = F.pmod(F.xxhash64("transaction_id", F.lit(1)), F.lit(10)) == 0
    order = DEDUPE_ORDER["transactions"]
    for n in range(len(ARRIVALS) + 1):
        raw.where((landing == n) | (again & (landing == n - 1))).write.parquet(f"{root}/landing/drop-{n}")
        stream_latest(spark, f"{root}/landing/drop-*", raw.schema, root, "transaction_id", order, "ingestion_date", DELAY)
    return read_latest(spark, raw.schema, root, "transaction_id", order)
