"""SparkSession construction with the semantics the pipeline relies on.

* UTC session time zone and TIMESTAMP_NTZ as the default timestamp type, so
  parquet timestamps, ``current_timestamp()`` and date arithmetic agree.
* AQE on (runtime coalescing, skew-join splitting, runtime broadcast choice
  from *measured* sizes).
* No UI server.
* ``spark.checkpoint.dir`` is read from the session; a scratch folder is
  created only in local mode; a cluster without one is an error.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SESSION_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_session_conf(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL conf the operators depend on (idempotent)."""
    for key in (
        "spark.sql.session.timeZone",
        "spark.sql.timestampType",
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.requireAllClusterKeysForCoPartition",
    ):
        spark.conf.set(key, SESSION_CONF[key])
    return spark


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "finspark") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only if unset in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="finspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return scratch


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the given files / folders (Hadoop FS, any cluster store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            total += fs.getContentSummary(path).getLength()
    return total


def size_shuffle_partitions(spark: SparkSession, paths: list[str], bytes_per_partition: int = 200 << 20,
                            floor: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size (about
    ``bytes_per_partition`` of input per shuffle partition, never below the
    cluster's cores); AQE then coalesces small stages down.  Returns it."""
    cores = spark.sparkContext.defaultParallelism
    n = max(floor or cores, -(-input_bytes(spark, paths) // bytes_per_partition))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n
