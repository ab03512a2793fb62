"""DuckDB oracle for the data-quality checks."""

from __future__ import annotations

from oracle.duckdb_sql import AS_OF, Q

MODEL_KEY = {
    "platinum_finance_exec_scorecard_daily": "platinum_scorecard_daily",
    "platinum_finance_exec_scorecard_monthly": "platinum_scorecard_monthly",
}


def M(model: str) -> str:
    return f"({Q[MODEL_KEY.get(model, model)]})"


SCHEMA_TESTS = [
    ("gold_monthly_revenue", "month", ("not_null", "unique")),
    ("gold_arr", "month", ("not_null", "unique")),
    ("gold_refund_rate", "date", ("not_null", "unique")),
    ("gold_failed_payment_rate", "date", ("not_null", "unique")),
    ("gold_cohort_retention", "cohort_month", ("not_null",)),
    ("gold_cohort_retention", "months_since_cohort", ("not_null",)),
    ("platinum_finance_exec_scorecard_daily", "date", ("not_null", "unique")),
    ("platinum_finance_exec_scorecard_monthly", "month", ("not_null", "unique")),
    ("platinum_anomalies_daily", "date", ("not_null",)),
    ("platinum_anomalies_daily", "metric_name", ("not_null",)),
] + [(f"bronze_{e}", "ingestion_date", ("not_null",))
     for e in ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")
] + [(f"bronze_{e}s", f"{e}_id", ("not_null", "unique"))
     for e in ("customer", "account", "transaction", "payment", "subscription", "refund")
] + [(f"silver_{e}s", f"{e}_id", ("unique",)) for e in ("customer", "account", "transaction", "subscription", "refund")]


def _status(col: str) -> str:
    return f"case when {col} > 0 then 'fail' else 'pass' end"


NOT_NULL = " union all ".join(
    f"select '{m}' as model_name, '{c}' as column_name, 'not_null' as test_name, "
    f"count(*) filter (where {c} is null) as failures from {M(m)} t"
    for m, c, k in SCHEMA_TESTS if "not_null" in k)
UNIQUE = " union all ".join(
    f"select '{m}' as model_name, '{c}' as column_name, 'unique' as test_name, "
    f"(select count(*) from (select {c} from {M(m)} t where {c} is not null group by {c} having count(*) > 1) d)"
    f" as failures"
    for m, c, k in SCHEMA_TESTS if "unique" in k)

Q["dq_not_null"] = f"select *, {_status('failures')} as status from ({NOT_NULL}) x"
Q["dq_unique"] = f"select *, {_status('failures')} as status from ({UNIQUE}) x"

MONITORED = [("gold_transaction_facts", "cast(created_at as date)"), ("gold_daily_revenue", "revenue_date"),
             ("gold_churn", "churn_month"), ("gold_mrr", "revenue_month")]
DATES = " union all ".join(f"select '{t}' as table_name, {c} as d from {M(t)} t" for t, c in MONITORED)
TABLES = "(values " + ", ".join(f"('{t}')" for t, _ in MONITORED) + ") tl(table_name)"

VOLUME = f"""
select tl.table_name,
  case when coalesce(n_days, 0) < 2 then 'skip' when prev_count = 0 then 'warn'
       when pct < -0.35 then 'fail' when pct > 0.60 then 'warn' else 'pass' end as status,
  case when coalesce(n_days, 0) < 2 then 'not enough history' when prev_count = 0 then 'previous day count was 0'
  end as reason,
  latest_date, latest_count, prev_date, prev_count, round(pct, 6) as pct_change
from {TABLES} left join (
  select *, case when prev_count = 0 then null
                 else cast(latest_count - prev_count as double) / prev_count end as pct
  from (
    select table_name,
      max(case when rn = 1 then d end) as latest_date, max(case when rn = 1 then n end) as latest_count,
      max(case when rn = 2 then d end) as prev_date, max(case when rn = 2 then n end) as prev_count,
      count(*) as n_days
    from (select *, row_number() over (partition by table_name order by d desc nulls last) as rn
          from (select table_name, d, count(*) as n from ({DATES}) a group by 1, 2) daily) r
    where rn <= 2 group by table_name
  ) p
) v on tl.table_name = v.table_name"""
Q["dq_volume"] = VOLUME

_CUT = "case when table_name = 'gold_churn' then null else {0} end as {0}"
Q["dq_volume_isolated"] = f"""
select table_name, case when table_name = 'gold_churn' then 'error' else status end as status,
  {", ".join(_CUT.format(c) for c in ("latest_date", "latest_count", "prev_date", "prev_count", "pct_change"))}
from ({VOLUME}) v"""

FRESH = f"""
select tl.table_name,
  case when max_date is null then 'fail' when cast({AS_OF} - max_date as bigint) <= 2 then 'pass' else 'fail' end
    as status,
  case when max_date is null then 'no rows' end as reason,
  max_date, cast({AS_OF} - max_date as bigint) as days_old
from {TABLES} left join (select table_name, max(d) as max_date from ({DATES}) a group by 1) m
  on tl.table_name = m.table_name"""
Q["dq_freshness"] = FRESH

Q["dq_status"] = f"""
with tests as (select bool_or(failures > 0) as tests_failed
               from ({NOT_NULL} union all {UNIQUE}) x),
vol as (select bool_or(status = 'fail') as vol_fail, bool_or(status in ('warn', 'error')) as vol_warn
        from ({VOLUME}) v),
fr as (select bool_or(status = 'fail') as fresh_fail, bool_or(status in ('warn', 'error')) as fresh_warn
       from ({FRESH}) f)
select case when tests_failed or vol_fail or fresh_fail then 'fail'
            when vol_warn or fresh_warn then 'warn' else 'pass' end as status,
  tests_failed, vol_fail, fresh_fail,
  concat_ws(' | ',
    case when tests_failed then 'dbt tests failed, likely schema or data quality regression in upstream models' end,
    case when vol_fail then 'volume dropped sharply, likely missing ingest or incremental filter issue' end,
    case when fresh_fail then 'freshness failure, likely pipeline did not load newest partition' end)
    as likely_causes
from tests, vol, fr"""

ACCEPTED = [
    ("bronze_accounts", "account_type", ("checking", "savings", "credit")),
    ("bronze_accounts", "status", ("active", "closed", "suspended")),
    ("bronze_transactions", "status", ("success", "failed", "pending")),
    ("bronze_payments", "payment_method", ("card", "bank")),
    ("bronze_payments", "status", ("success", "failed")),
    ("bronze_subscriptions", "plan_name", ("basic", "pro", "enterprise")),
    ("bronze_subscriptions", "status", ("active", "paused", "canceled")),
    ("bronze_refunds", "refund_reason", ("customer_dispute", "merchant_error", "duplicate_charge")),
]
Q["dq_accepted_values"] = "select *, " + _status("invalid_rows") + " as status from (" + " union all ".join(
    f"select '{m}' as model_name, '{c}' as column_name, '{','.join(v)}' as accepted_values, "
    f"count(*) filter (where {c} is not null and {c} not in ({', '.join(repr(x) for x in v)})) as invalid_rows "
    f"from {M(m)} t" for m, c, v in ACCEPTED) + ") x"

REFS = [
    ("silver_accounts", "customer_id", "silver_customers", "customer_id"),
    ("silver_transactions", "account_id", "silver_accounts", "account_id"),
    ("silver_transactions", "customer_id", "silver_customers", "customer_id"),
    ("silver_payments", "transaction_id", "silver_transactions", "transaction_id"),
    ("silver_refunds", "transaction_id", "silver_transactions", "transaction_id"),
    ("silver_subscriptions", "customer_id", "silver_customers", "customer_id"),
]
Q["dq_referential"] = "select *, " + _status("orphan_rows") + " as status from (" + " union all ".join(
    f"select '{c}' as child_table, '{ck}' as child_column, '{pa}' as parent_table, "
    f"(select count(*) from {M(c)} ch where ch.{ck} is not null and not exists "
    f"(select 1 from {M(pa)} pr where pr.{pk} = ch.{ck})) as orphan_rows"
    for c, ck, pa, pk in REFS) + ") x"

GRAINS = [("platinum_anomalies_daily", ("date", "metric_name")),
          ("gold_cohort_retention", ("cohort_month", "months_since_cohort")),
          ("gold_mrr", ("revenue_month",)), ("gold_churn", ("churn_month",)),
          ("bronze_payments", ("transaction_id", "attempt_number")),
          ("bronze_refunds", ("transaction_id", "amount", "refund_reason", "refunded_at"))]
Q["dq_grain"] = "select *, " + _status("duplicate_groups") + " as status from (" + " union all ".join(
    f"select '{m}' as model_name, '{','.join(cols)}' as grain, (select count(*) from (select {', '.join(cols)} "
    f"from {M(m)} t group by {', '.join(cols)} having count(*) > 1) d) as duplicate_groups"
    for m, cols in GRAINS) + ") x"

DAILY = [("gold_daily_revenue", "revenue_date"), ("platinum_finance_exec_scorecard_daily", "date")]
Q["dq_missing_days"] = " union all ".join(f"""
select '{m}' as model_name, cast(c.d as date) as missing_date
from (select unnest(generate_series(min({col}), max({col}), interval 1 day)) as d from {M(m)} t) c
where cast(c.d as date) not in (select {col} from {M(m)} t2 where {col} is not null)""" for m, col in DAILY)

Q["dq_measured_status"] = Q["dq_status"]
