"""PII masking and standardisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_normalized(x: Column | str) -> Column:
    """``md5(lower(trim(x)))`` (trim strips spaces only)."""
    return F.md5(F.lower(F.trim(_c(x))))


def hash_raw(x: Column | str) -> Column:
    return F.md5(_c(x).cast("string"))


def standardize_email(x: Column | str) -> Column:
    """Canonical mailbox: trimmed, lower-cased, ``+tag`` removed and dots
    removed from the local part (``J.Doe+x@Mail.com`` -> ``jdoe@mail.com``)."""
    e = F.lower(F.trim(_c(x)))
    local = F.regexp_replace(F.regexp_replace(F.substring_index(e, "@", 1), r"\+.*$", ""), r"\.", "")
    domain = F.substring_index(e, "@", -1)
    return F.when(e.contains("@"), F.concat(local, F.lit("@"), domain)).otherwise(e)
