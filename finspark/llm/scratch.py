"""Intermediate tables in the shared folder of the session, and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.session import ensure_checkpoint_dir


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_FOLDERS: list[str] = []
_TABLES: list[str] = []


def remove_written(spark: SparkSession) -> None:
    """Remove the tables this process has written; only when no result that reads them is needed."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _FOLDERS:
        path = jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(conf).delete(path, True)
    while _TABLES:
        spark.sql(f"drop table if exists {_TABLES.pop()}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under spark.checkpoint.dir and read back: lineage ends
    there, any executor can read it, and readers take only the columns they need."""
    spark = df.sparkSession
    _FOLDERS.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}")
    path = f"{_FOLDERS[-1]}/{name}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str) -> DataFrame:
    """``df`` written as a table in the shared warehouse, bucketed by ``key``: what is grouped or joined by
    that key meets the rows where they lie, and they are not shuffled."""
    spark = df.sparkSession
    _TABLES.append(f"llm_{uuid.uuid4().hex}")
    df.write.bucketBy(shuffle_partitions(spark), key).format("parquet").option("compression", "zstd").saveAsTable(_TABLES[-1])
    return spark.table(_TABLES[-1])


#: Rows of a few numbers that may be broadcast (some 16 MB); they are counted first.
SMALL_ROWS = 1_000_000


def if_small(df: DataFrame) -> DataFrame:
    """``df``, written and counted, to be broadcast if it has few rows and joined by shuffle otherwise."""
    df = written(df, "side")
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of the links; a component is its smallest node.

    Alternates two star contractions (each node hands its smallest neighbour to its
    larger neighbours, then to its smaller ones) until the links stand still, which
    takes about log(longest path) rounds.  Only per-node minima are aggregated, so a
    node with very many links is neither collected nor joined to itself.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .filter("u <> v").distinct(), "links")
    before = _fingerprint(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).filter("u > v").distinct())
        edges = written(small, "links")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select(F.col("v").alias("node"), F.col("v").alias("component")))
