"""Checks of many tables as jobs of their own, so that one table's fault is one row.

A union of all tables' checks is a single job: a file that cannot be read ends it for every
table.  Here each check runs by itself, a few at a time; a failure, whether while planning or
while running, becomes that table's error row and the others stand.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

#: Checks that run side by side.
WORKERS = 4


def error_text(e: Exception) -> str:
    """The whole message of a failure; of a failed job, the causes that Spark reports with it."""
    text = str(e)
    cause = getattr(e, "java_exception", None)
    while cause is not None and cause.getCause() is not None:
        cause = cause.getCause()
        text += f"\ncaused by {cause.toString()}"
    return text


def run_isolated(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]], failed: Callable[[str, str], tuple],
                 schema: str, workers: int = WORKERS) -> DataFrame:
    """The rows of all checks, in their order.  A check plans and runs in its own job and returns a few
    rows (findings of one table); ``failed(name, text)`` is the row of one that does not."""
    def one(name: str) -> list[tuple]:
        try:
            return [tuple(r) for r in checks[name]().collect()]
        except Exception as e:  # noqa: BLE001  any failure of one table is its finding
            return [failed(name, error_text(e))]

    with ThreadPoolExecutor(max_workers=workers) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(one), name) for name in checks]
        rows = [row for run in runs for row in run.result()]
    return spark.createDataFrame(rows, schema)
