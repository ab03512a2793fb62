"""Bronze ingestion with Structured Streaming.

New raw files landing in a folder are picked up by a file source with a
fixed schema; each micro-batch is merged into the bronze table by key (delete + insert, only
files that can hold a key are rewritten) inside ``foreachBatch``.  The batch id names the
version written, counted from the table's version when the stream began, so
a batch replayed after a failure finds its version in place: the sink is idempotent and the
checkpoint gives exactly-once progress.  ``availableNow`` drains what has landed and stops, which is how
the batch pipeline schedules it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.operators.bronze import ENTITY_KEYS, with_load_time
from finspark.sources.files import CSV_OPTIONS, ENTITY_SCHEMAS
from finspark.sources.manifest import ManifestTable


def _base_version(spark: SparkSession, table: str, checkpoint: str) -> int:
    """The table's version when this stream began (0: no table yet), kept beside its checkpoint."""
    path = f"{checkpoint.rstrip('/')}/base_version"
    if not _complete(spark, path):
        spark.createDataFrame([(ManifestTable(spark, table, "").version(),)], "version int").write.mode("overwrite").json(path)
    return spark.read.schema("version int").json(path).first().version


def _merge_batch(spark: SparkSession, table: str, entity: str, base: int):
    """Batch ``b`` merges into version ``base + b`` and puts the next one in place; a batch
    whose version is there has been merged.  The version before it must be there, but for
    the first batch of a table that did not exist; a lost version is an error."""
    target = ManifestTable(spark, table, ENTITY_KEYS[entity])

    def merge(batch: DataFrame, batch_id: int) -> None:
        before = base + batch_id
        if before and not target.has_version(before):
            raise RuntimeError(f"version {before} of {table} is missing")
        if not target.has_version(before + 1):
            target.merge(with_load_time(batch, "bronze_loaded_at"), before + 1)

    return merge


def _complete(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stream_bronze(spark: SparkSession, landing_dir: str, table: str, entity: str, checkpoint: str,
                  fmt: str = "csv", max_files_per_trigger: int | None = None) -> None:
    """Drain ``landing_dir`` into the bronze table (availableNow trigger)."""
    reader = spark.readStream.schema(ENTITY_SCHEMAS[entity])
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.format(fmt).load(landing_dir)
    q = (src.writeStream.foreachBatch(_merge_batch(spark, table, entity, _base_version(spark, table, checkpoint)))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def watermarked_daily_counts(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Late-data-aware daily event counts for a streaming events source:
    a watermark on the event time bounds the state kept per window.
    Watermarks need a TIMESTAMP (session time zone, UTC here) event time."""
    return (events.withColumn("ts", F.col("ts").cast("timestamp_ltz")).withWatermark("ts", delay)
            .groupBy(F.window("ts", "1 day").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("w.start").alias("window_start"), "event_type", "events"))


STREAM_FIRST_DROP_BEFORE = "1998-01-01"


def stream_bronze_demo(spark: SparkSession, raw: DataFrame, entity: str, root: str) -> DataFrame:
    """Two landings of raw CSV files drained by two availableNow runs of the
    same stream (same checkpoint): the second run only sees the new files."""
    from finspark.sources.files import write_entity_csv
    landing, table, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/_checkpoint"
    first = F.col("ingestion_date") < F.lit(STREAM_FIRST_DROP_BEFORE).cast("date")
    write_entity_csv(raw.where(first), f"{landing}/drop=1")
    stream_bronze(spark, f"{landing}/*", table, entity, ckpt)
    write_entity_csv(raw.where(~first), f"{landing}/drop=2")
    stream_bronze(spark, f"{landing}/*", table, entity, ckpt)
    return ManifestTable(spark, table, ENTITY_KEYS[entity]).read()


def stream_event_counts(spark: SparkSession, events: DataFrame, root: str, delay: str = "2 days") -> DataFrame:
    """Events landed as files, counted per day and type by a watermarked
    streaming aggregation in update mode.  Each micro-batch appends its
    updated windows (tagged with the batch id) to a parquet sink; the
    latest row per window is the current count."""
    landing, sink, ckpt = f"{root}/landing", f"{root}/counts", f"{root}/_checkpoint"
    events.write.mode("overwrite").parquet(landing)
    src = spark.readStream.schema(events.schema).parquet(landing)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(sink)

    q = (watermarked_daily_counts(src, delay).writeStream.outputMode("update").foreachBatch(append)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    out = spark.read.parquet(sink)
    latest = out.groupBy("window_start", "event_type").agg(
        F.max_by("events", "batch_id").alias("events"))
    return latest.select(F.to_date("window_start").alias("day"), "event_type", "events")
