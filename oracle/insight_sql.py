"""DuckDB oracle for the finance insight and the document PII scan."""

from __future__ import annotations

from finspark.config import EMAIL_PATTERN, PHONE_PATTERN
from oracle.duckdb_sql import Q, with_base


def insight_sql(where: str = "", documented: bool = False) -> str:
    extra = ""
    if documented:
        extra = """,
    case when latest_txn < prev_txn * 0.5 then 'Low transaction volume: ' || cast(latest_txn as varchar)
         || ' transactions versus ' || cast(prev_txn as varchar) || ' prior day' end,
    case when abs(pct) > 0.25 then 'Large revenue movement: net revenue changed ' || printf('%.1f%%', pct * 100) end"""
    return with_base(f"""
select
  case when latest_date is null then 'fail' when drivers != '' then 'warn' else 'pass' end as status,
  case when latest_date is null then 'unknown' else cast(latest_date as varchar) end as as_of_date,
  case when latest_date is null then 'No daily revenue data found'
       when pct is null then 'Net revenue reported, but prior day baseline missing'
       when pct < -0.10 then 'Net revenue down ' || printf('%.1f%%', pct * 100) || ' versus prior day'
       when pct > 0.10 then 'Net revenue up ' || printf('%.1f%%', pct * 100) || ' versus prior day'
       else 'Net revenue stable versus prior day' end as headline,
  latest_date, latest_net as net_revenue, latest_gross as gross_transaction_amount,
  latest_refunds as total_refunded_amount, round(pct, 6) as net_revenue_change_pct,
  round(rate, 6) as refund_rate_amount_based,
  case when latest_date is null then '' else drivers end as drivers,
  case when latest_date is null then 'gold_daily_revenue missing or empty' else '' end as notes
from (
  select *, concat_ws(' | ',
    case when rate > 0.05 then 'Refund pressure: Refund rate ' || printf('%.2f%%', rate * 100) || ' is elevated' end
    {extra}) as drivers
  from (
    select *,
      case when prev_net is null or prev_net = 0 then null else (latest_net - prev_net) / prev_net end as pct,
      case when latest_gross is null or latest_gross = 0 then null else latest_refunds / latest_gross end as rate
    from (
      select max(case when rn = 1 then revenue_date end) as latest_date,
        cast(max(case when rn = 1 then net_revenue end) as double) as latest_net,
        cast(max(case when rn = 2 then net_revenue end) as double) as prev_net,
        cast(max(case when rn = 1 then gross_transaction_amount end) as double) as latest_gross,
        cast(max(case when rn = 1 then total_refunded_amount end) as double) as latest_refunds,
        max(case when rn = 1 then paid_transaction_count + unpaid_transaction_count end) as latest_txn,
        max(case when rn = 2 then paid_transaction_count + unpaid_transaction_count end) as prev_txn
      from (select *, row_number() over (order by revenue_date desc) as rn
            from (select * from gold_daily_revenue {where} order by revenue_date desc limit 2) t2) r
    ) s
  ) s2
) s3""")


Q["finance_insight"] = insight_sql()
Q["finance_insight_empty"] = insight_sql("where revenue_date <= DATE '1994-12-31'")
Q["doc_finance_drivers"] = insight_sql(documented=True)

Q["pii_scan_documents"] = f"""
select doc_id, cast(len(regexp_extract_all(text, '{EMAIL_PATTERN}', 0)) as bigint) as email_matches,
  cast(len(regexp_extract_all(text, '{PHONE_PATTERN}', 1)) as bigint) as phone_matches
from documents"""

# Value-pattern scan: per table, the string columns that are not ids (model
# schemas), every row, patterns matched per row.
SAMPLED = [
    ("bronze.bronze_accounts", "bronze_accounts", ["account_type", "status"]),
    ("bronze.bronze_transactions", "bronze_transactions", ["currency", "merchant_name", "status", "card_last_four"]),
    ("bronze.bronze_payments", "bronze_payments", ["payment_method", "status"]),
    ("bronze.bronze_subscriptions", "bronze_subscriptions", ["plan_name", "status"]),
    ("bronze.bronze_refunds", "bronze_refunds", ["refund_reason"]),
    ("silver.silver_customers", "silver_customers", ["full_name_hash", "email_hash", "phone_hash", "address_hash"]),
    ("silver.silver_accounts", "silver_accounts", ["account_type", "normalized_status"]),
    ("silver.silver_transactions", "silver_transactions",
     ["currency", "merchant_name", "status", "card_last_four_hash"]),
    ("silver.silver_payments", "silver_payments", ["payment_method", "final_payment_status"]),
    ("silver.silver_subscriptions", "silver_subscriptions", ["plan_name", "status"]),
    ("silver.silver_refunds", "silver_refunds", ["refund_reason"]),
    ("platinum.platinum_anomalies_daily", "platinum_anomalies_daily", ["metric_name", "reason"]),
]


def _value_scan(obj: str, key: str, cols: list[str]) -> str:
    return f"""
select '{obj}' as object,
  coalesce(bool_or(regexp_matches(concat_ws(' ', {', '.join(cols)}), '{EMAIL_PATTERN}')), false) as email_detected,
  coalesce(bool_or(regexp_matches(concat_ws(' ', {', '.join(cols)}), '{PHONE_PATTERN}')), false) as phone_detected,
  '{','.join(cols)}' as sampled_columns, cast(null as varchar) as scan_error
from ({Q[key]}) s"""


Q["pii_scan_values"] = ("select *, email_detected or phone_detected as finding from ("
                        + " union all ".join(_value_scan(o, k, c) for o, k, c in SAMPLED) + ") x")

# Column-name scan over every model of the four layers (names from DESCRIBE).
ENTITIES = ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")
LAYER_TABLES = (
    [("bronze", f"bronze_{e}", f"bronze_{e}") for e in ENTITIES]
    + [("silver", f"silver_{e}", f"silver_{e}") for e in ENTITIES]
    + [("gold", m, m) for m in ("gold_transaction_facts", "gold_daily_revenue", "gold_monthly_revenue", "gold_mrr",
                                "gold_arr", "gold_churn", "gold_customer_metrics", "gold_refund_rate",
                                "gold_failed_payment_rate", "gold_cohort_retention")]
    + [("platinum", "platinum_finance_exec_scorecard_daily", "platinum_scorecard_daily"),
       ("platinum", "platinum_finance_exec_scorecard_monthly", "platinum_scorecard_monthly"),
       ("platinum", "platinum_anomalies_daily", "platinum_anomalies_daily")])

COLUMNS = " union all ".join(
    f"select '{layer}' as layer, '{name}' as table_name, column_name from (describe {Q[key]}) d"
    for layer, name, key in LAYER_TABLES)

Q["pii_scan_columns"] = f"""
select layer || '.' || table_name as object, 'pii_column_name' as type,
  string_agg(column_name, ',' order by column_name) as evidence, 'fail' as severity
from ({COLUMNS}) c
where lower(column_name) in ('full_name', 'name', 'email', 'phone', 'address')
group by layer, table_name"""

Q["compliance_status"] = f"""
select case when col_findings > 0 then 'fail' when col_findings + value_findings > 0 then 'warn' else 'pass' end
    as status,
  cast({len(LAYER_TABLES)} as bigint) as checked_objects, col_findings + value_findings as findings
from (select (select count(*) from ({Q['pii_scan_columns']}) a) as col_findings,
             (select count(*) from ({Q['pii_scan_values']}) b where finding) as value_findings) x"""


# Catalog listing of gold and platinum (column order from DESCRIBE); the
# models also carry their load-time audit column, listed last.
AUDITED = {"gold_transaction_facts", "gold_daily_revenue", "gold_mrr", "gold_churn", "gold_customer_metrics"}


def _catalog(layer: str, name: str, key: str) -> str:
    body = f"""select '{layer}' as layer, '{name}' as table_name, column_name,
  cast(row_number() over () - 1 as integer) as ordinal from (describe {Q[key]}) d"""
    if name in AUDITED:
        body += f"""
union all select '{layer}', '{name}', 'gold_loaded_at', cast((select count(*) from (describe {Q[key]}) c) as integer)"""
    return body


Q["compliance_catalog"] = " union all ".join(
    _catalog(layer, name, key) for layer, name, key in LAYER_TABLES if layer in ("gold", "platinum"))

# The insight report read back from JSON: flat, the date as text.
Q["report_insight"] = (
    "select * replace (cast(latest_date as varchar) as latest_date) from (" + Q["finance_insight"] + ") r")
