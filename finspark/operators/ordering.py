"""Per-group ordered analytics that stay balanced when one group is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked_with_next(df: DataFrame, group: str, order: Sequence[str], next_of: str,
                     partitions: int | None = None) -> DataFrame:
    """Adds ``seq`` (row_number within ``group`` by ``order``) and ``next_value``
    (``lead(next_of)`` in that order) without putting a whole group in one task.

    Rows are range-partitioned on (group, order...), so a group holding a
    large share of the data spans several partitions.  Each (partition,
    group) piece — at most one partition's worth of rows — is ranked
    locally; per-piece counts and first values, ordered by partition id
    within the group (at most ``partitions`` rows per group), give each
    piece its rank offset and the value that follows its last row.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The piece id is the range partition id; checkpointing fixes it once so
    # the two branches below (and any recomputation) agree on it.
    ordered = (df.repartitionByRange(n, group, *order).withColumn("_pid", F.spark_partition_id())
               .checkpoint(eager=True))
    local_w = Window.partitionBy("_pid", group).orderBy(*order)
    local = (ordered.withColumn("_local", F.row_number().over(local_w))
             .withColumn("_local_next", F.lead(next_of).over(local_w)))
    pieces = local.groupBy("_pid", group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.col(next_of), F.struct(*[F.col(c) for c in order])).alias("_first"))
    across = Window.partitionBy(group).orderBy("_pid")
    pieces = pieces.select(
        "_pid", group, "_n",
        F.coalesce(F.sum("_n").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.lead("_first").over(across).alias("_next_piece_first"))
    out = local.join(pieces, ["_pid", group])
    return out.select(
        *[c for c in df.columns],
        (F.col("_local") + F.col("_offset")).cast("bigint").alias("seq"),
        # Only a piece's last row looks into the next piece; a null next value inside a piece stays.
        F.when(F.col("_local") == F.col("_n"), F.col("_next_piece_first"))
         .otherwise(F.col("_local_next")).alias("next_value"))
