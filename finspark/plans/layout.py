"""Layers laid out for their joins: tables bucketed and sorted by transaction.

The fact joins all go by ``transaction_id``.  Written once in buckets of that key, silver transactions,
final payments, refund sums and facts lie hash-partitioned on disk, and every later join of them reads
bucket beside bucket without a shuffle.  All four have one row per transaction, so no bucket can hold a
hot key: refunds, of which a transaction may have any number, are stored as their sums.

A layout is a folder with a table each and a ``layout`` file, written last, that names their columns and
buckets; any session opens it from there, and a folder without it is no layout.  Empty tables and null
keys (one row) are kept as they are.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from finspark.config import PipelineConfig
from finspark.operators.docmetrics import final_statuses
from finspark.operators.ingest import scratch_dir
from finspark.plans.pipeline import MODELS, Pipeline, for_output
from finspark.plans.registry import pipeline, query

KEY = "transaction_id"
SOURCES = ("silver_transactions", "silver_payments", "refunds_per_transaction")
FACTS = "gold_transaction_facts"
LAYOUT = "model string, buckets int, columns string"


def _table(path: str) -> str:
    return "layout_" + hashlib.md5(path.encode()).hexdigest()


def _write(df: DataFrame, path: str, buckets: int) -> DataFrame:
    (df.write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(_table(path)))
    return df.sparkSession.table(_table(path))


def write_layout(p: Pipeline, out: str, buckets: int | None = None) -> Pipeline:
    """Write the tables of a pipeline's fact joins in buckets (as many as shuffle partitions unless given)
    and return a pipeline that reads them.  The facts are derived from the written tables,
    already lie in their buckets, and are written without another shuffle."""
    out = out.rstrip("/")
    buckets = buckets or int(p.spark.conf.get("spark.sql.shuffle.partitions"))
    tables = {name: _write(p.ref(name).repartition(buckets, KEY), f"{out}/{name}", buckets) for name in SOURCES}
    tables[FACTS] = _write(Pipeline(p.spark, p.sf_dir, p.config, overrides=tables).ref(FACTS), f"{out}/{FACTS}", buckets)
    rows = [(name, buckets, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)) for name, df in tables.items()]
    p.spark.createDataFrame(rows, LAYOUT).coalesce(1).write.mode("overwrite").json(f"{out}/layout")
    return open_layout(p.spark, p.sf_dir, out, p.config)


def open_layout(spark: SparkSession, sf_dir: str, out: str, config: PipelineConfig | None = None) -> Pipeline:
    """A pipeline over a written layout, also in a session that did not write it."""
    out, tables = out.rstrip("/"), {}
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/layout/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        raise FileNotFoundError(f"{out} holds no finished layout")
    for name, buckets, columns in spark.read.schema(LAYOUT).json(f"{out}/layout").collect():
        table = _table(f"{out}/{name}")
        spark.sql(f"create table if not exists {table} ({columns}) using parquet clustered by ({KEY}) sorted by ({KEY}) "
                  f"into {buckets} buckets location '{out}/{name}'")
        tables[name] = spark.table(table)
    return Pipeline(spark, sf_dir, config, overrides=tables)


@query("layout_transaction_facts")
def layout_transaction_facts_q(spark, sf_dir):
    """The facts joined again from bucketed tables."""
    p = write_layout(pipeline(spark, sf_dir), scratch_dir(spark, "layout"))
    return for_output(MODELS[FACTS](p))


@query("layout_final_status")
def layout_final_status_q(spark, sf_dir):
    return final_statuses(write_layout(pipeline(spark, sf_dir), scratch_dir(spark, "layout")))
