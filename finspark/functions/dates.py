"""Date helpers built from Spark built-ins (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def run_date(as_of: dt.date | None) -> Column:
    """The run's date: the given one, or the current date."""
    return F.current_date() if as_of is None else F.lit(as_of)


def day_of(ts: Column | str) -> Column:
    """``date(ts)``."""
    return F.to_date(_c(ts))


def month_start(x: Column | str) -> Column:
    """``date_trunc('month', x)`` as a DATE (first day of the month)."""
    return F.trunc(F.to_date(_c(x)), "month")


def month_boundaries_between(a: Column | str, b: Column | str) -> Column:
    """Number of month boundaries crossed from ``a`` to ``b``.

    This is calendar arithmetic ``(y2 - y1) * 12 + (m2 - m1)``: Jan 31 ->
    Feb 1 counts 1, unlike ``months_between`` / ``datediff(MONTH, ...)``.
    """
    a, b = _c(a), _c(b)
    return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("int")


def month_series(start: Column | str, end: Column | str) -> Column:
    """Months (as first-of-month DATEs) visited by a series that starts at
    ``start`` and repeatedly adds one month, clipping to month ends (so the
    day drifts down: 31 Jan, 29 Feb, 29 Mar, ...), while the value stays
    ``<= end``.

    Closed form: every month from ``trunc(start)`` to ``trunc(end)``; the last
    month is kept only if the drifted day
    ``least(day(start), shortest month length in the span)`` is ``<= day(end)``.
    Empty when ``start > end``.  One ``sequence`` + two higher-order
    functions; no join and no Python.
    """
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    months = F.sequence(F.trunc(s, "month"), F.trunc(e, "month"), F.expr("interval 1 month"))
    shortest = F.array_min(F.transform(months, lambda m: F.dayofmonth(F.last_day(m))))
    keep_last = F.least(F.dayofmonth(s), shortest) <= F.dayofmonth(e)
    trimmed = F.when(keep_last, months).otherwise(F.slice(months, 1, F.size(months) - 1))
    return F.when(s <= e, trimmed).otherwise(F.array().cast("array<date>"))


def last_series_month(start: Column | str, end: Column | str) -> Column:
    """The last month of ``month_series(start, end)`` without building it; NULL where that is empty.

    The shortest month of the span follows from its first and last month: 28 days with a February
    of a common year (of two Februaries in a row one is), 29 with one of a leap year alone,
    else 30 with any 30-day month, else 31."""
    s, e = F.to_date(_c(start)), F.to_date(_c(end))
    a, b = (F.year(x) * 12 + F.month(x) - 1 for x in (s, e))

    def count(month: int) -> Column:  # how often the span holds the month (January is 0)
        return F.floor((b - month) / 12) - F.floor((a - 1 - month) / 12)

    february = F.floor((b - 1) / 12)  # the year of the last one
    leap = (february % 4 == 0) & ((february % 100 != 0) | (february % 400 == 0))
    short = count(3) + count(5) + count(8) + count(10)
    shortest = (F.when(count(1) > 1, 28).when(count(1) == 1, F.when(leap, 29).otherwise(28))
                .when(short > 0, 30).otherwise(31))
    last = F.trunc(e, "month")
    keep = F.least(F.dayofmonth(s), shortest) <= F.dayofmonth(e)
    return F.when(s <= e, F.when(keep, last).otherwise(F.add_months(last, -1)))
