"""Checks measured while layers are written.

``write_measured`` writes a model and observes it on the way: rows, NULLs of tested columns and
values outside accepted lists are counted by the writing tasks (``DataFrame.observe``), with no
pass of their own.  What an observation cannot hold, rows per day and repeated values, is
aggregated once from the one column of the files just written.  All of it goes to the run's metrics table

    (model_name, metric, column_name, day, value)

which the checks of :mod:`finspark.operators.quality` read in place of the models.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finspark.plans.pipeline import Pipeline

SCHEMA = "model_name string, metric string, column_name string, day date, value bigint"
ROWS, NULLS, INVALID, REPEATED, DAY = "rows", "nulls", "invalid", "repeated", "day"
Row = tuple[str, str, str | None, dt.date | None, int]


def observed(df: DataFrame, model: str) -> tuple[DataFrame, Observation, list[tuple[str, str | None]]]:
    """``df`` with an observation, and the (metric, column) that its values stand for."""
    from finspark.operators.quality import ACCEPTED_VALUES, SCHEMA_TESTS
    wanted: list[tuple[str, str | None]] = [(ROWS, None)]
    values = [F.count(F.lit(1))]
    for m, c, kinds in SCHEMA_TESTS:
        if m == model and "not_null" in kinds:
            wanted.append((NULLS, c))
            values.append(F.count_if(F.col(c).isNull()))
    for m, c, allowed in ACCEPTED_VALUES:
        if m == model:
            wanted.append((INVALID, c))
            values.append(F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(*allowed)))
    seen = Observation()
    return df.observe(seen, *(v.alias(f"m{i}") for i, v in enumerate(values))), seen, wanted


def _after(df: DataFrame, model: str) -> DataFrame | None:
    """Rows per day and repeated values of a written model, each from one column."""
    from finspark.operators.quality import MONITORED_DATE_COLUMNS, SCHEMA_TESTS, date_column
    none = F.lit(None)
    parts = []
    if model in MONITORED_DATE_COLUMNS:
        day = F.to_date(F.col(date_column(df, MONITORED_DATE_COLUMNS[model])))
        parts.append(df.select(day.alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("value"))
                     .select(F.lit(DAY).alias("metric"), none.cast("string").alias("column_name"), "day", "value"))
    for m, c, kinds in SCHEMA_TESTS:
        if m == model and "unique" in kinds:
            repeated = df.where(F.col(c).isNotNull()).groupBy(c).count().where(F.col("count") > 1)
            parts.append(repeated.agg(F.count(F.lit(1)).alias("value"))
                         .select(F.lit(REPEATED).alias("metric"), F.lit(c).alias("column_name"), none.cast("date").alias("day"), "value"))
    out = None
    for part in parts:
        out = part if out is None else out.union(part)
    return None if out is None else out.select(F.lit(model).alias("model_name"), "metric", "column_name", "day", "value")


def write_measured(p: Pipeline, model: str, path: str, metrics: str) -> None:
    """Write a model to ``path`` (later refs read it from there) and its metrics to ``metrics/model=<model>``."""
    spark = p.spark
    df, seen, wanted = observed(p.ref(model), model)
    df.write.mode("overwrite").parquet(path)
    counts = seen.get
    rows = [(model, metric, column, None, counts[f"m{i}"]) for i, (metric, column) in enumerate(wanted)]
    written = spark.read.parquet(path)
    p.override(model, written)
    out = spark.createDataFrame(rows, SCHEMA)
    after = _after(written, model)
    (out if after is None else out.union(after)).coalesce(1).write.mode("overwrite").parquet(f"{metrics.rstrip('/')}/of={model}")


def read_metrics(spark: SparkSession, metrics: str) -> DataFrame | None:
    """A run's metrics; none where no run has written any."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(metrics)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(SCHEMA + ", of string").parquet(metrics).drop("of")


def use_metrics(p: Pipeline, metrics: str) -> Pipeline:
    """Let the checks of ``p`` read the metrics of a finished run."""
    found = read_metrics(p.spark, metrics)
    if found is not None:
        p.metrics = found
        p.measured = {r[0] for r in found.where(F.col("metric") == ROWS).select("model_name").collect()}  # names of models
    return p
