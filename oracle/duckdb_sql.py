"""Independent DuckDB SQL for every checkable query.

Each statement inlines the fixture mapping (raw entities from the driver
tables) and the silver layer as CTEs, then computes the model exactly as the
model definitions state — including the 1:N refund fan-out joins — so it
checks the Spark plans' rewrites (pre-aggregation, generators, windows).

Output conventions shared with the Spark side: money DOUBLE, counts BIGINT,
month keys DATE, ratios rounded to 6 dp, window averages / baselines /
z-scores rounded to 4 dp.
"""

from __future__ import annotations

AS_OF = "DATE '2002-01-01'"

FIXTURE_CTES = {
    "raw_customers": """
select cast(k as varchar) as customer_id, c_name as full_name,
  concat(case dup when 0 then ' ' else 'new.' end, replace(c_name, '#', '.'), '@Example.com') as email,
  concat('555-01', lpad(cast(k % 100 as varchar), 2, '0')) as phone,
  concat(cast(c_nationkey as varchar), ' Main St') as address,
  concat('dev-', cast(k % 997 as varchar)) as device_id,
  cast(d as timestamp) as created_at,
  (d + (cast(k % 4 + dup * 5 as int))) as ingestion_date
from (
  select c_custkey k, c_name, c_nationkey, (date '1995-01-01' + (cast(c_custkey % 700 as int))) d, 0 dup from customer
  union all
  select c_custkey, c_name, c_nationkey, (date '1995-01-01' + (cast(c_custkey % 700 as int))), 1 from customer
  where c_custkey % 20 = 0
) b""",
    "raw_accounts": """
select cast(k as varchar) as account_id,
  concat(case when k % 89 = 0 then 'gone-' else '' end, cast(ck as varchar)) as customer_id,
  case j when 0 then 'checking' when 1 then 'savings' else 'credit' end as account_type,
  case when k % 97 = 0 then 'frozen' when k % 10 < 7 then 'active' when k % 10 < 9 then 'closed' else 'suspended' end as status,
  d as opened_at,
  case when k % 10 in (7, 8) then (d + (cast(30 + k % 500 as int))) end as closed_at,
  (d + (cast(k % 3 + dup * 6 as int))) as ingestion_date
from (
  select c_custkey ck, c_custkey * 3 + n.j k, n.j, (date '1995-01-01' + (cast(c_custkey % 700 + n.j * 9 as int))) d, dup
  from customer cross join (select 0 j union all select 1 union all select 2) n cross join (values (0), (1)) t(dup)
  where n.j <= c_custkey % 3 and (dup = 0 or c_custkey % 40 = 0)
) b""",
    "raw_transactions": """
select cast(k as varchar) as transaction_id, cast(ck * 3 as varchar) as account_id, cast(ck as varchar) as customer_id,
  cast(o_totalprice as decimal(18,2)) as amount, 'USD' as currency, o_orderpriority as merchant_name,
  case when k % 20 < 17 then 'success' when k % 20 < 19 then 'failed' else 'pending' end as status,
  cast(d as timestamp) + (k % 1440) * interval '1' minute as created_at,
  case when k % 20 < 17 then cast((d + (cast(k % 3 as int))) as timestamp) end as settled_at,
  (d + (cast(k % 6 + dup * 7 as int))) as ingestion_date,
  cast(1000 + k % 9000 as varchar) as card_last_four,
  concat('dev-', cast(ck % 997 as varchar)) as device_id
from (
  select o_orderkey k, o_custkey ck, o_totalprice, o_orderpriority, cast(o_orderdate as date) d, 0 dup from orders
  union all
  select o_orderkey, o_custkey, o_totalprice, o_orderpriority, cast(o_orderdate as date), 1 from orders
  where o_orderkey % 50 = 0
) b""",
    "raw_payments": """
select cast(k * 10 + a as varchar) as payment_id, cast(k as varchar) as transaction_id,
  case when k % 53 = 0 then 'wire' when k % 2 = 0 then 'card' else 'bank' end as payment_method,
  case when a = 1 + k % 3 and k % 7 <> 0 then 'success' else 'failed' end as status,
  cast(a as int) as attempt_number,
  cast(d as timestamp) + (a * 23 + k % 13 - case when k % 41 = 0 and a = 2 then 60 else 0 end) * interval '1' hour
    as attempted_at,
  case when k % 101 <> 0 or a <> 1 then (d + (cast(a + k % 3 + dup * 2 as int))) end as ingestion_date
from (
  select o_orderkey k, n.a, cast(o_orderdate as date) d, dup
  from orders cross join (select 1 a union all select 2 union all select 3) n cross join (values (0), (1)) t(dup)
  where n.a <= 1 + o_orderkey % 3 and not (o_orderkey % 43 = 0 and n.a = 2)
    and (dup = 0 or (o_orderkey % 37 = 0 and n.a = 1))
) b""",
    "raw_subscriptions": """
select cast(k as varchar) as subscription_id, cast(ck as varchar) as customer_id,
  case when k % 71 = 0 then 'trial' when (ck + j) % 3 = 0 then 'basic' when (ck + j) % 3 = 1 then 'pro'
    else 'enterprise' end as plan_name,
  case (ck + 2 * j) % 3 when 0 then 'active' when 1 then 'paused' else 'canceled' end as status,
  d as start_date,
  case when (ck + 2 * j) % 3 <> 0 then (d + (cast(30 + ck % 150 as int))) end as end_date,
  (d + (cast(k % 3 + dup * 6 as int))) as ingestion_date
from (
  select c_custkey ck, n.j, c_custkey * 4 + n.j k, (date '1996-01-01' + (cast(c_custkey % 900 + 90 * n.j as int))) d, dup
  from customer cross join (select 0 j union all select 1 union all select 2 union all select 3) n
    cross join (values (0), (1)) t(dup)
  where n.j <= c_custkey % 4 and (dup = 0 or c_custkey % 25 = 0)
) b""",
    "raw_refunds": """
select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, amount, d, again) as refund_id,
  concat(case when l_partkey % 61 = 0 then 'gone-' else '' end, cast(l_orderkey as varchar)) as transaction_id,
  amount,
  case when l_partkey % 67 = 0 then 'other' when l_suppkey % 3 = 0 then 'customer_dispute'
    when l_suppkey % 3 = 1 then 'merchant_error' else 'duplicate_charge' end as refund_reason,
  d as refunded_at,
  (d + (cast(l_suppkey % 4 + dup * 5 as int))) as ingestion_date
from (
  select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_extendedprice as decimal(18,2)) as amount,
    cast(l_shipdate as date) d, again, dup
  from lineitem cross join (values (0), (1)) r(again) cross join (values (0), (1)) t(dup)
  where l_returnflag = 'R' and (again = 0 or l_partkey % 30 = 0) and (dup = 0 or l_suppkey % 25 = 0)
) b""",
}


def _dn(cols: str) -> str:
    return ", ".join(f"{c.strip()} desc nulls last" for c in cols.split(","))


SILVER_CTES = {
    "silver_customers": f"""
select customer_id, md5(lower(trim(full_name))) as full_name_hash, md5(lower(trim(email))) as email_hash,
  md5(phone) as phone_hash, md5(address) as address_hash, device_id, created_at, ingestion_date
from (select *, row_number() over (partition by customer_id order by
  {_dn('ingestion_date, full_name, email, phone, address, device_id, created_at')}) as rn
  from raw_customers) x where rn = 1""",
    "silver_accounts": f"""
select account_id, customer_id, account_type,
  case when status = 'closed' then 'closed' when status = 'suspended' then 'inactive' else 'active' end
    as normalized_status,
  opened_at, closed_at, ingestion_date
from (select *, row_number() over (partition by account_id order by
  {_dn('ingestion_date, customer_id, account_type, status, opened_at, closed_at')}) as rn
  from raw_accounts) x where rn = 1""",
    "silver_transactions": f"""
select transaction_id, account_id, customer_id, amount, currency, merchant_name, status, created_at, settled_at,
  ingestion_date, md5(cast(card_last_four as varchar)) as card_last_four_hash, device_id
from (select *, row_number() over (partition by transaction_id order by
  {_dn('ingestion_date, created_at, amount, status, settled_at, account_id, customer_id, currency, merchant_name, card_last_four, device_id')}) as rn
  from raw_transactions) x where rn = 1""",
    "silver_payments": f"""
select payment_id, transaction_id, payment_method, status as final_payment_status, attempt_number, attempted_at,
  ingestion_date
from (select *, row_number() over (partition by transaction_id order by
  case when status = 'success' then 1 else 2 end,
  {_dn('attempted_at, payment_id, attempt_number, ingestion_date, payment_method')}) as rn
  from raw_payments) x where rn = 1""",
    "silver_subscriptions": f"""
select subscription_id, customer_id, plan_name, status, start_date, end_date, ingestion_date
from (select *, row_number() over (partition by subscription_id order by
  {_dn('ingestion_date, customer_id, plan_name, status, start_date, end_date')}) as rn
  from raw_subscriptions) x where rn = 1""",
    "silver_refunds": f"""
select refund_id, transaction_id, amount, refund_reason, refunded_at, ingestion_date
from (select *, row_number() over (partition by refund_id order by
  {_dn('ingestion_date, amount, refund_reason, refunded_at, transaction_id')}) as rn
  from raw_refunds) x where rn = 1""",
}

GOLD_CTES = {
    "gold_transaction_facts": """
select tx.transaction_id, tx.customer_id, tx.account_id, tx.created_at, tx.amount as transaction_amount,
  coalesce(rf.refund_total, 0) as refunded_amount,
  if(coalesce(fp.final_payment_status = 'success', false), tx.amount - coalesce(rf.refund_total, 0), 0)
    as net_amount,
  coalesce(fp.final_payment_status = 'success', false) as is_paid
from silver_transactions tx
left join silver_payments fp using (transaction_id)
left join (select transaction_id, sum(amount) as refund_total from silver_refunds group by all) rf
  using (transaction_id)""",
    "gold_daily_revenue": """
select cast(created_at as date) as revenue_date,
  sum(transaction_amount) as gross_transaction_amount, sum(refunded_amount) as total_refunded_amount,
  sum(net_amount) as net_revenue,
  cast(sum(case when is_paid then 1 else 0 end) as bigint) as paid_transaction_count,
  cast(sum(case when not is_paid then 1 else 0 end) as bigint) as unpaid_transaction_count
from gold_transaction_facts group by all""",
    "scorecard_daily_base": """
select rev.d as date, rev.gross as gross_revenue,
  rev.gross - coalesce(rfd.refunded, 0) as net_revenue,
  coalesce(rfd.refunded, 0) as refunded_amount,
  if(rev.gross = 0, null, cast(coalesce(rfd.refunded, 0) as double) / cast(rev.gross as double)) as refund_rate,
  if(pst.n_att = 0, null, cast(pst.n_fail as double) / pst.n_att) as failed_payment_rate
from (select cast(created_at as date) as d, sum(amount) as gross from silver_transactions
      where status = 'success' group by all) rev
left join (select refunded_at as d, sum(amount) as refunded from silver_refunds group by all) rfd on rfd.d = rev.d
left join (select cast(attempted_at as date) as d, count(*) as n_att,
             sum(case when final_payment_status <> 'success' then 1 else 0 end) as n_fail
           from silver_payments group by all) pst on pst.d = rev.d""",
}

BASE_CTES = {**FIXTURE_CTES, **SILVER_CTES, **GOLD_CTES}


def with_base(final_select: str, extra: dict[str, str] | None = None) -> str:
    ctes = {**BASE_CTES, **(extra or {})}
    body = ",\n".join(f"{name} as ({sql}\n)" for name, sql in ctes.items())
    return f"with {body}\n{final_select}"


BRONZE_COLUMNS = {
    "customers": "customer_id, full_name, email, phone, address, device_id, created_at, ingestion_date",
    "accounts": "account_id, customer_id, account_type, status, opened_at, closed_at, ingestion_date",
    "transactions": "transaction_id, account_id, customer_id, cast(amount as double) as amount, currency, "
                    "merchant_name, status, created_at, settled_at, ingestion_date, card_last_four, device_id",
    "payments": "payment_id, transaction_id, payment_method, status, attempt_number, attempted_at, ingestion_date",
    "subscriptions": "subscription_id, customer_id, plan_name, status, start_date, end_date, ingestion_date",
    "refunds": "refund_id, transaction_id, cast(amount as double) as amount, refund_reason, refunded_at, "
               "ingestion_date",
}

SILVER_OUT = {
    "customers": "*",
    "accounts": "*",
    "transactions": "* replace (cast(amount as double) as amount)",
    "payments": "*",
    "subscriptions": "*",
    "refunds": "* replace (cast(amount as double) as amount)",
}

ANALYTICS_OUT = {
    "customers": "customer_id, email_hash, phone_hash, full_name_hash, device_id, created_at, ingestion_date",
    "accounts": "*",
    "payments": "payment_id, transaction_id, final_payment_status, ingestion_date",
    "refunds": "refund_id, transaction_id, cast(amount as double) as amount, refunded_at, ingestion_date",
    "subscriptions": "subscription_id, customer_id, status, start_date, ingestion_date",
    "transactions": "transaction_id, account_id, customer_id, status, settled_at, ingestion_date",
}

Q: dict[str, str] = {}

for _ent, _cols in BRONZE_COLUMNS.items():
    Q[f"bronze_{_ent}"] = with_base(f"select {_cols} from raw_{_ent}")
    Q[f"silver_{_ent}"] = with_base(f"select {SILVER_OUT[_ent]} from silver_{_ent}")
    Q[f"view_admin_{_ent}"] = with_base(f"select {SILVER_OUT[_ent]} from silver_{_ent}")
    Q[f"view_analytics_{_ent}"] = with_base(f"select {ANALYTICS_OUT[_ent]} from silver_{_ent}")

Q["gold_transaction_facts"] = with_base("""
select transaction_id, customer_id, account_id, created_at, cast(transaction_amount as double) as transaction_amount,
  cast(refunded_amount as double) as refunded_amount, cast(net_amount as double) as net_amount, is_paid
from gold_transaction_facts""")

Q["gold_daily_revenue"] = with_base("""
select revenue_date, cast(gross_transaction_amount as double) as gross_transaction_amount,
  cast(total_refunded_amount as double) as total_refunded_amount, cast(net_revenue as double) as net_revenue,
  cast(paid_transaction_count as bigint) as paid_transaction_count,
  cast(unpaid_transaction_count as bigint) as unpaid_transaction_count
from gold_daily_revenue""")

Q["gold_monthly_revenue"] = with_base("""
select month, cast(sum(amt) as double) as gross_revenue,
  cast(sum(amt) - coalesce(sum(ramt), 0) as double) as net_revenue,
  cast(coalesce(sum(ramt), 0) as double) as refund_amount
from (select cast(date_trunc('month', s.created_at) as date) as month, s.amount as amt, x.amount as ramt
      from silver_transactions s left join silver_refunds x on x.transaction_id = s.transaction_id
      where s.status = 'success') j
group by month""")

MRR_EXPANDED = f"""
select subscription_id, customer_id, plan_name, monthly_price, status,
  cast(date_trunc('month', ts) as date) as revenue_month
from (
  select sub.subscription_id, sub.customer_id, sub.plan_name, pl.monthly_price, sub.status,
    unnest(generate_series(cast(sub.start_date as timestamp),
                           cast(coalesce(sub.end_date, {AS_OF}) as timestamp), interval '1 month')) as ts
  from silver_subscriptions sub
  join (values ('basic', 29), ('pro', 79), ('enterprise', 199)) pl(plan_name, monthly_price)
    on pl.plan_name = sub.plan_name
) e"""

Q["gold_mrr"] = with_base("""
select revenue_month, cast(sum(monthly_price) as bigint) as mrr, count(distinct customer_id) as active_customers
from mrr_expanded where status = 'active' group by all""", {"mrr_expanded": MRR_EXPANDED})

Q["gold_arr"] = with_base("""
select cast(date_trunc('month', start_date) as date) as month,
  cast(12 * sum(case plan_name when 'basic' then 10 when 'pro' then 30 when 'enterprise' then 100 else 0 end)
       as bigint) as arr
from silver_subscriptions where status = 'active' group by all""")

Q["gold_churn"] = with_base("""
select cast(date_trunc('month', end_date) as date) as churn_month,
  count(distinct customer_id) as churned_customers
from silver_subscriptions where end_date is not null and status = 'canceled' group by all""")

Q["gold_customer_metrics"] = with_base(f"""
select {AS_OF} as snapshot_date, count(*) as active_customers,
  count(*) filter (where exists (select 1 from gold_transaction_facts f
                                 where f.customer_id = act.customer_id and f.is_paid)) as paying_customers,
  count(*) filter (where exists (select 1 from gold_transaction_facts f
                                 where f.customer_id = act.customer_id and f.refunded_amount > 0))
    as refunded_customers,
  count(*) filter (where exists (select 1 from silver_subscriptions sb
                                 where sb.customer_id = act.customer_id and sb.status = 'canceled'))
    as churned_customers
from (select distinct customer_id from silver_accounts
      where normalized_status = 'active' and customer_id is not null) act""")

Q["gold_refund_rate"] = with_base("""
select date, cast(paid as double) as paid_amount, cast(refunded as double) as refunded_amount,
  round(if(paid = 0, null, cast(refunded as double) / cast(paid as double)), 6) as refund_rate
from (select cast(s.created_at as date) as date, sum(s.amount) as paid, coalesce(sum(x.amount), 0) as refunded
      from silver_transactions s left join silver_refunds x on x.transaction_id = s.transaction_id
      where s.status = 'success' group by all) g""")

Q["gold_failed_payment_rate"] = with_base("""
select date, attempt_count, failed_count,
  round(if(attempt_count = 0, null, cast(failed_count as double) / attempt_count), 6) as failed_payment_rate
from (select cast(attempted_at as date) as date, count(*) as attempt_count,
        cast(sum(case when final_payment_status <> 'success' then 1 else 0 end) as bigint) as failed_count
      from silver_payments group by all) g""")

Q["gold_cohort_retention"] = with_base("""
select cf.first_month as cohort_month,
  cast((year(ca.active_month) - year(cf.first_month)) * 12 + month(ca.active_month) - month(cf.first_month)
       as int) as months_since_cohort,
  any_value(sz.members) as customers_in_cohort, count(*) as customers_retained,
  round(count(*) / any_value(sz.members), 6) as retention_rate
from cohort_first cf
join cohort_active ca on ca.customer_id = cf.customer_id
join (select first_month, count(*) as members from cohort_first group by all) sz on sz.first_month = cf.first_month
group by cf.first_month, ca.active_month
having (year(ca.active_month) - year(cf.first_month)) * 12 + month(ca.active_month) - month(cf.first_month) >= 0""", {
    "cohort_first": """select customer_id, cast(date_trunc('month', min(created_at)) as date) as first_month
from silver_transactions where status = 'success' and customer_id is not null group by customer_id""",
    "cohort_active": """select distinct customer_id, cast(date_trunc('month', created_at) as date) as active_month
from silver_transactions where status = 'success' and customer_id is not null""",
})

Q["active_sets_retention"] = Q["gold_cohort_retention"]

Q["active_sets_distinct"] = with_base("""
select kind, span as month, count(distinct customer_id) as active_customers from (
  select 'quarter' as kind, cast(date_trunc('quarter', month) as date) as span, customer_id from active_months
  union all select 'year', cast(date_trunc('year', month) as date), customer_id from active_months
  union all select '12 months', m.month, a.customer_id
  from (select distinct month from active_months) m
  join active_months a on a.month <= m.month and a.month > m.month - interval 12 month
) s group by all""", {
    "active_months": """select distinct customer_id, cast(date_trunc('month', created_at) as date) as month
from silver_transactions where status = 'success' and customer_id is not null""",
})

SCORECARD_DAILY = """
select date, gross_revenue, net_revenue, refund_rate, failed_payment_rate,
  avg(net_revenue) over (order by date rows between 6 preceding and current row) as net_revenue_7d_avg,
  net_revenue - lag(net_revenue, 7) over (order by date) as net_revenue_wow_change
from scorecard_daily_base"""

Q["platinum_scorecard_daily"] = with_base("""
select date, cast(gross_revenue as double) as gross_revenue, cast(net_revenue as double) as net_revenue,
  round(refund_rate, 6) as refund_rate, round(failed_payment_rate, 6) as failed_payment_rate,
  round(cast(net_revenue_7d_avg as double), 4) as net_revenue_7d_avg,
  cast(net_revenue_wow_change as double) as net_revenue_wow_change
from scorecard_daily""", {"scorecard_daily": SCORECARD_DAILY})

Q["platinum_scorecard_monthly"] = with_base("""
select month, cast(gross as double) as gross_revenue, cast(gross - refunded as double) as net_revenue,
  subs * 12 as arr_proxy,
  round(if(gross = 0, null, cast(refunded as double) / cast(gross as double)), 6) as refund_rate,
  cast((gross - refunded) - lag(gross - refunded) over (order by month) as double) as net_revenue_mom_change,
  subs * 12 - lag(subs * 12) over (order by month) as arr_mom_change
from (
  select rm.month, rm.gross, rm.refunded, am.subs
  from (select cast(date_trunc('month', s.created_at) as date) as month, sum(s.amount) as gross,
          coalesce(sum(x.amount), 0) as refunded
        from silver_transactions s left join silver_refunds x on x.transaction_id = s.transaction_id
        where s.status = 'success' group by all) rm
  left join (select cast(date_trunc('month', start_date) as date) as month, count(distinct subscription_id) as subs
             from silver_subscriptions where status = 'active' group by all) am on am.month = rm.month
) m""")


def anomalies_sql(source: str) -> str:
    """Trailing-30-row z-score flags: the three metrics unpivoted (NULLs
    kept, so every metric has a row per day) and windowed per metric."""
    return f"""
select date, metric_name, round(metric_value, 6) as metric_value, round(mu, 4) as baseline_value,
  round(z, 4) as z_score, coalesce(abs(z) >= 3, false) as is_anomaly,
  case when z is null then 'insufficient_history' when abs(z) >= 3 then 'deviation_over_3_std'
       else 'normal_range' end as reason
from (
  select *, if(sd is null or sd = 0, null, (metric_value - mu) / sd) as z
  from (
    select date, metric_name, metric_value,
      avg(metric_value) over hist as mu, stddev_samp(metric_value) over hist as sd
    from (select * from (select date, cast(net_revenue as double) as net_revenue,
                                cast(refund_rate as double) as refund_rate,
                                cast(failed_payment_rate as double) as failed_payment_rate from {source}) wide
          unpivot include nulls (metric_value for metric_name in (net_revenue, refund_rate, failed_payment_rate))
         ) lng
    window hist as (partition by metric_name order by date rows between 30 preceding and 1 preceding)
  ) st
) zz"""


Q["platinum_anomalies_daily"] = with_base(
    anomalies_sql("scorecard_daily"), {"scorecard_daily": SCORECARD_DAILY})
