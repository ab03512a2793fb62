"""Join shapes that stay balanced when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fanout_left_join(left: DataFrame, right: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``left LEFT JOIN right`` for a 1:N relationship, written as
    ``(right INNER JOIN left) UNION ALL (left ANTI JOIN right)``.

    In a plain left outer join only the left side of a skewed partition can
    be split by AQE; when the *many* side (right) holds a hot key the whole
    fan-out lands in one task.  As an inner join, AQE's skew handling can
    split the right side's hot partition and replicate the single matching
    left row; the anti join adds the unmatched left rows.  Both branches
    reuse the same shuffle of each input.
    """
    keys = [key] if isinstance(key, str) else list(key)
    right_cols = [c for c in right.columns if c not in keys]
    matched = right.join(left, keys, "inner").select(*left.columns, *right_cols)
    unmatched = left.join(right.select(*keys), keys, "left_anti").select(
        *left.columns, *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in right_cols])
    return matched.unionByName(unmatched)
