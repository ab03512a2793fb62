"""Daily finance summary over gold_daily_revenue.

The two latest revenue days come from a distributed top-2
(``orderBy(desc).limit(2)`` -> TakeOrderedAndProject), are pivoted with
``max(when(rn = k, ...))`` and turned into a one-row report with the
headline and driver rules as column expressions.  A global aggregate always
yields one row, so an empty input produces the "no data" report in the same
plan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finspark.config import (DRIVER_REFUND_PRESSURE, HEADLINE_DOWN, HEADLINE_MOVE_PCT, HEADLINE_NO_BASELINE,
                             HEADLINE_NO_DATA, HEADLINE_STABLE, HEADLINE_UP, NOTE_NO_DATA, REFUND_PRESSURE_RATE)
from finspark.plans.pipeline import Pipeline
from finspark.plans.registry import pipeline, query

# Documented (not coded) extra driver rules, off unless asked for.
LOW_VOLUME_RATIO = 0.5
LARGE_MOVE_PCT = 0.25


def pct_text(x: Column, decimals: int) -> Column:
    """Python's ``{x:.Nf%}``: value × 100 with N decimals and a % sign."""
    return F.format_string(f"%.{decimals}f%%", x * 100)


def fill(template: str, key: str, value: Column) -> Column:
    """A fixed text with one ``{key}`` placeholder filled by a column."""
    before, after = template.split("{" + key + "}")
    return F.concat(F.lit(before), value, F.lit(after))


def latest_two_days(p: Pipeline, upto: dt.date | None = None) -> DataFrame:
    d = p.ref("gold_daily_revenue")
    if upto is not None:
        d = d.where(F.col("revenue_date") <= F.lit(upto))
    top2 = d.orderBy(F.col("revenue_date").desc()).limit(2)
    r = top2.withColumn("rn", F.row_number().over(Window.orderBy(F.col("revenue_date").desc())))

    def at(k: int, c: str) -> Column:
        return F.max(F.when(F.col("rn") == k, F.col(c)))

    return r.agg(
        at(1, "revenue_date").alias("latest_date"),
        at(1, "net_revenue").cast("double").alias("latest_net"),
        at(2, "net_revenue").cast("double").alias("prev_net"),
        at(1, "gross_transaction_amount").cast("double").alias("latest_gross"),
        at(1, "total_refunded_amount").cast("double").alias("latest_refunds"),
        (at(1, "paid_transaction_count") + at(1, "unpaid_transaction_count")).alias("latest_txn"),
        (at(2, "paid_transaction_count") + at(2, "unpaid_transaction_count")).alias("prev_txn"),
    )


def finance_insight(p: Pipeline, upto: dt.date | None = None, documented_drivers: bool = False) -> DataFrame:
    s = latest_two_days(p, upto)
    pct = F.when(F.col("prev_net").isNull() | (F.col("prev_net") == 0), F.lit(None).cast("double")) \
        .otherwise((F.col("latest_net") - F.col("prev_net")) / F.col("prev_net"))
    rate = F.when(F.col("latest_gross").isNull() | (F.col("latest_gross") == 0), F.lit(None).cast("double")) \
        .otherwise(F.col("latest_refunds") / F.col("latest_gross"))
    s = s.select("*", pct.alias("pct"), rate.alias("rate"))
    headline = (F.when(F.col("pct").isNull(), HEADLINE_NO_BASELINE)
                .when(F.col("pct") < -HEADLINE_MOVE_PCT, fill(HEADLINE_DOWN, "pct", pct_text(F.col("pct"), 1)))
                .when(F.col("pct") > HEADLINE_MOVE_PCT, fill(HEADLINE_UP, "pct", pct_text(F.col("pct"), 1)))
                .otherwise(HEADLINE_STABLE))
    drivers = [F.when(F.col("rate") > REFUND_PRESSURE_RATE,
                      fill(DRIVER_REFUND_PRESSURE, "rate", pct_text(F.col("rate"), 2)))]
    if documented_drivers:
        drivers += [
            F.when(F.col("latest_txn") < F.col("prev_txn") * LOW_VOLUME_RATIO, F.concat(
                F.lit("Low transaction volume: "), F.col("latest_txn").cast("string"),
                F.lit(" transactions versus "), F.col("prev_txn").cast("string"), F.lit(" prior day"))),
            F.when(F.abs(F.col("pct")) > LARGE_MOVE_PCT, F.concat(
                F.lit("Large revenue movement: net revenue changed "), pct_text(F.col("pct"), 1))),
        ]
    driver_text = F.concat_ws(" | ", *drivers)
    empty = F.col("latest_date").isNull()
    return s.select(
        F.when(empty, "fail").when(driver_text != "", "warn").otherwise("pass").alias("status"),
        F.when(empty, "unknown").otherwise(F.col("latest_date").cast("string")).alias("as_of_date"),
        F.when(empty, HEADLINE_NO_DATA).otherwise(headline).alias("headline"),
        "latest_date",
        F.col("latest_net").alias("net_revenue"),
        F.col("latest_gross").alias("gross_transaction_amount"),
        F.col("latest_refunds").alias("total_refunded_amount"),
        F.round("pct", 6).alias("net_revenue_change_pct"),
        F.round("rate", 6).alias("refund_rate_amount_based"),
        F.when(empty, "").otherwise(driver_text).alias("drivers"),
        F.when(empty, NOTE_NO_DATA).otherwise("").alias("notes"),
    )


# Report date before the first fixture day: exercises the empty-input path.
EMPTY_UPTO = dt.date(1994, 12, 31)


@query("finance_insight")
def finance_insight_q(spark, sf_dir):
    return finance_insight(pipeline(spark, sf_dir))


@query("finance_insight_empty")
def finance_insight_empty_q(spark, sf_dir):
    return finance_insight(pipeline(spark, sf_dir), upto=EMPTY_UPTO)


@query("doc_finance_drivers")
def doc_finance_drivers_q(spark, sf_dir):
    return finance_insight(pipeline(spark, sf_dir), documented_drivers=True)
