"""Numeric helpers: guarded ratios (output rounding lives in plans.registry)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``CASE WHEN den = 0 THEN NULL ELSE num * 1.0 / den END`` in double
    precision (ANSI-mode division by zero never raises)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(n / d)
