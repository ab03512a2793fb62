"""The six raw finance entities, derived from the driver's tables.

The mapping (FIXTURES.md §3) is expressed with narrow ``select`` lists and
generators instead of joins: the reference's "duplicate" copies and the
1..n child rows (accounts, payment attempts, subscriptions) come from
``explode(sequence(...))`` on the parent row, so each entity is one scan of
one driver table and no shuffle.

Some keys carry planted faults, so that the checks have something to find:
unknown enum values, orphan keys, repeated loads, repeated refunds, missing
ingestion dates, and retries that skip or go back in time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.sources.tables import read_table


def _e(sql: str) -> Column:
    return F.expr(sql)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    base = src.select(
        F.col("c_custkey").alias("k"), "c_name", "c_nationkey",
        _e("date_add(date'1995-01-01', cast(c_custkey % 700 as int))").alias("d"),
        F.explode(_e("sequence(0, if(c_custkey % 20 = 0, 1, 0))")).alias("dup"),
    )
    return base.select(
        _e("cast(k as string)").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        _e("concat(case dup when 0 then ' ' else 'new.' end, replace(c_name, '#', '.'), '@Example.com')").alias("email"),
        _e("concat('555-01', lpad(cast(k % 100 as string), 2, '0'))").alias("phone"),
        _e("concat(cast(c_nationkey as string), ' Main St')").alias("address"),
        _e("concat('dev-', cast(k % 997 as string))").alias("device_id"),
        _e("cast(d as timestamp_ntz)").alias("created_at"),
        _e("date_add(d, cast(k % 4 + dup * 5 as int))").alias("ingestion_date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "customer", ["c_custkey"])
    base = src.select(
        F.col("c_custkey").alias("ck"),
        F.explode(_e("sequence(0, cast(c_custkey % 3 as int))")).alias("j"),
    ).select(
        "ck", "j", F.explode(_e("sequence(0, if(ck % 40 = 0, 1, 0))")).alias("dup"),
    ).select(
        "ck", "j", "dup", _e("ck * 3 + j").alias("k"),
        _e("date_add(date'1995-01-01', cast(ck % 700 + j * 9 as int))").alias("d"),
    )
    return base.select(
        _e("cast(k as string)").alias("account_id"),
        _e("concat(case when k % 89 = 0 then 'gone-' else '' end, cast(ck as string))").alias("customer_id"),
        _e("case j when 0 then 'checking' when 1 then 'savings' else 'credit' end").alias("account_type"),
        _e("case when k % 97 = 0 then 'frozen' when k % 10 < 7 then 'active' when k % 10 < 9 then 'closed' else 'suspended' end").alias("status"),
        F.col("d").alias("opened_at"),
        _e("case when k % 10 in (7, 8) then date_add(d, cast(30 + k % 500 as int)) end").alias("closed_at"),
        _e("date_add(d, cast(k % 3 + dup * 6 as int))").alias("ingestion_date"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "orders",
                     ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate"])
    base = src.select(
        F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("ck"), "o_totalprice", "o_orderpriority",
        _e("cast(o_orderdate as date)").alias("d"),
        F.explode(_e("sequence(0, if(o_orderkey % 50 = 0, 1, 0))")).alias("dup"),
    )
    return base.select(
        _e("cast(k as string)").alias("transaction_id"),
        _e("cast(ck * 3 as string)").alias("account_id"),
        _e("cast(ck as string)").alias("customer_id"),
        _e("cast(o_totalprice as decimal(18,2))").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderpriority").alias("merchant_name"),
        _e("case when k % 20 < 17 then 'success' when k % 20 < 19 then 'failed' else 'pending' end").alias("status"),
        _e("cast(d as timestamp_ntz) + make_dt_interval(0, 0, cast(k % 1440 as int), 0)").alias("created_at"),
        _e("case when k % 20 < 17 then cast(date_add(d, cast(k % 3 as int)) as timestamp_ntz) end").alias("settled_at"),
        _e("date_add(d, cast(k % 6 + dup * 7 as int))").alias("ingestion_date"),
        _e("cast(1000 + k % 9000 as string)").alias("card_last_four"),
        _e("concat('dev-', cast(ck % 997 as string))").alias("device_id"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    base = src.select(
        F.col("o_orderkey").alias("k"), _e("cast(o_orderdate as date)").alias("d"),
        F.explode(_e("sequence(1, cast(1 + o_orderkey % 3 as int))")).alias("a"),
    ).where("not (k % 43 = 0 and a = 2)").select(
        "k", "d", "a", F.explode(_e("sequence(0, if(k % 37 = 0 and a = 1, 1, 0))")).alias("dup"))
    return base.select(
        _e("cast(k * 10 + a as string)").alias("payment_id"),
        _e("cast(k as string)").alias("transaction_id"),
        _e("case when k % 53 = 0 then 'wire' when k % 2 = 0 then 'card' else 'bank' end").alias("payment_method"),
        _e("case when a = 1 + k % 3 and k % 7 <> 0 then 'success' else 'failed' end").alias("status"),
        _e("cast(a as int)").alias("attempt_number"),
        _e("cast(d as timestamp_ntz) + make_dt_interval(0, "
           "cast(a * 23 + k % 13 - if(k % 41 = 0 and a = 2, 60, 0) as int), 0, 0)").alias("attempted_at"),
        _e("case when k % 101 <> 0 or a <> 1 then date_add(d, cast(a + k % 3 + dup * 2 as int)) end").alias("ingestion_date"),
    )


def subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "customer", ["c_custkey"])
    base = src.select(
        F.col("c_custkey").alias("ck"),
        F.explode(_e("sequence(0, cast(c_custkey % 4 as int))")).alias("j"),
    ).select(
        "ck", "j", F.explode(_e("sequence(0, if(ck % 25 = 0, 1, 0))")).alias("dup"),
    ).select(
        "ck", "j", "dup", _e("ck * 4 + j").alias("k"),
        _e("date_add(date'1996-01-01', cast(ck % 900 + 90 * j as int))").alias("d"),
    )
    return base.select(
        _e("cast(k as string)").alias("subscription_id"),
        _e("cast(ck as string)").alias("customer_id"),
        _e("case when k % 71 = 0 then 'trial' when (ck + j) % 3 = 0 then 'basic' when (ck + j) % 3 = 1 then 'pro' "
           "else 'enterprise' end").alias("plan_name"),
        _e("case (ck + 2 * j) % 3 when 0 then 'active' when 1 then 'paused' else 'canceled' end").alias("status"),
        F.col("d").alias("start_date"),
        _e("case when (ck + 2 * j) % 3 <> 0 then date_add(d, cast(30 + ck % 150 as int)) end").alias("end_date"),
        _e("date_add(d, cast(k % 3 + dup * 6 as int))").alias("ingestion_date"),
    )


def refunds(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = read_table(spark, sf_dir, "lineitem",
                     ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag"])
    base = src.where("l_returnflag = 'R'").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        _e("cast(l_extendedprice as decimal(18,2))").alias("amount"), _e("cast(l_shipdate as date)").alias("d"),
        F.explode(_e("sequence(0, if(l_partkey % 30 = 0, 1, 0))")).alias("again"),
    ).select("*", F.explode(_e("sequence(0, if(l_suppkey % 25 = 0, 1, 0))")).alias("dup"))
    return base.select(
        # (order, line number) is not unique: all columns that tell returned lines apart make the key.
        _e("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, amount, d, again)").alias("refund_id"),
        _e("concat(case when l_partkey % 61 = 0 then 'gone-' else '' end, cast(l_orderkey as string))").alias("transaction_id"),
        "amount",
        _e("case when l_partkey % 67 = 0 then 'other' when l_suppkey % 3 = 0 then 'customer_dispute' "
           "when l_suppkey % 3 = 1 then 'merchant_error' else 'duplicate_charge' end").alias("refund_reason"),
        F.col("d").alias("refunded_at"),
        _e("date_add(d, cast(l_suppkey % 4 + dup * 5 as int))").alias("ingestion_date"),
    )


ENTITY_BUILDERS = {
    "customers": customers,
    "accounts": accounts,
    "transactions": transactions,
    "payments": payments,
    "subscriptions": subscriptions,
    "refunds": refunds,
}
