"""DuckDB oracle for documented metric variants and triage queries."""

from __future__ import annotations

from oracle.duckdb_sql import AS_OF, MRR_EXPANDED, SCORECARD_DAILY, Q, anomalies_sql, with_base

MRR = {"mrr_expanded": MRR_EXPANDED}

Q["doc_churn_events"] = with_base("""
select subscription_id, customer_id, min(end_date) as churn_date from silver_subscriptions
where status = 'canceled' group by subscription_id, customer_id""")

Q["doc_customer_churn"] = with_base("""
select customer_id, min(end_date) as churn_date from silver_subscriptions where status = 'canceled'
group by customer_id""")

Q["doc_daily_revenue_paid"] = with_base("""
select cast(created_at as date) as revenue_date, cast(sum(transaction_amount) as double) as gross_revenue,
  cast(sum(refunded_amount) as double) as refunded_revenue, cast(sum(net_amount) as double) as net_revenue,
  count(*) as transaction_count
from gold_transaction_facts where is_paid group by 1""")

Q["doc_daily_revenue_settled"] = with_base("""
select cast(created_at as date) as revenue_date, cast(sum(amount) as double) as gross_revenue,
  count(*) as transaction_count
from silver_transactions where status = 'success' and amount > 0 and settled_at is not null group by 1""")

Q["doc_monthly_rollup"] = with_base("""
select cast(date_trunc('month', revenue_date) as date) as month, cast(sum(net_revenue) as double)
  as monthly_net_revenue
from gold_daily_revenue group by 1""")

Q["doc_mrr_by_subscription"] = with_base("""
select revenue_month as month, subscription_id, customer_id, plan_name as plan, monthly_price as mrr_amount
from mrr_expanded where status = 'active'""", MRR)

Q["doc_arr_from_mrr"] = with_base("""
select revenue_month as month, cast(sum(mrr) * 12 as bigint) as arr_amount
from (select revenue_month, sum(monthly_price) as mrr from mrr_expanded where status = 'active'
      group by revenue_month) m
group by 1""", MRR)

Q["doc_refund_rate_amount"] = with_base("""
select cast(created_at as date) as date,
  round(cast(sum(refunded_amount) as double) / nullif(cast(sum(transaction_amount) as double), 0), 6)
    as refund_rate
from gold_transaction_facts where is_paid group by 1""")

Q["doc_refund_rate_count"] = with_base("""
select date, success_transactions, refunded_transactions,
  round(case when success_transactions = 0 then null
        else refunded_transactions * 1.0 / success_transactions end, 6) as refund_rate
from (
  select cast(t.created_at as date) as date, count(*) as success_transactions,
    count(r.transaction_id) as refunded_transactions
  from silver_transactions t
  left join (select distinct transaction_id from silver_refunds) r on t.transaction_id = r.transaction_id
  where t.status = 'success' group by 1
) g""")

Q["doc_failed_rate_attempt"] = with_base("""
select date, attempt_count, failed_count,
  round(case when attempt_count = 0 then null else failed_count * 1.0 / attempt_count end, 6)
    as failed_payment_rate
from (
  select cast(attempted_at as date) as date, count(*) as attempt_count,
    cast(sum(case when status = 'failed' then 1 else 0 end) as bigint) as failed_count
  from (select *, row_number() over (partition by payment_id order by ingestion_date desc nulls last,
          attempted_at desc nulls last, status desc nulls last, transaction_id desc nulls last) as rn
        from raw_payments) x
  where rn = 1 group by 1
) g""")

Q["doc_cohort_retained"] = (
    "select cohort_month, months_since_cohort, customers_retained as retained_customers from ("
    + Q["gold_cohort_retention"] + ") c")

Q["doc_customer_metrics"] = with_base("""
select c.customer_id, tx.first_transaction_date,
  cast(coalesce(tx.lifetime_revenue, 0) as double) as lifetime_revenue,
  coalesce(tx.total_transactions, 0) as total_transactions,
  coalesce(a.flag, false) as active_customer_flag,
  coalesce(tx.paying, false) as paying_customer_flag,
  coalesce(tx.refunded, false) as refunded_customer_flag,
  coalesce(ch.flag, false) as churned_customer_flag
from (select customer_id from silver_customers) c
left join (select customer_id, min(cast(created_at as date)) as first_transaction_date,
             sum(net_amount) as lifetime_revenue, count(*) as total_transactions,
             bool_or(is_paid) as paying, bool_or(refunded_amount > 0) as refunded
           from gold_transaction_facts group by customer_id) tx on c.customer_id = tx.customer_id
left join (select distinct customer_id, true as flag from silver_accounts where normalized_status = 'active') a
  on c.customer_id = a.customer_id
left join (select distinct customer_id, true as flag from silver_subscriptions where status = 'canceled') ch
  on c.customer_id = ch.customer_id""")

Q["doc_final_status"] = with_base("""
select f.transaction_id,
  case when p.final_payment_status = 'success' and f.refunded_amount > 0 then 'refunded'
       when p.final_payment_status = 'success' then 'paid'
       when p.final_payment_status = 'failed' then 'failed' else 'pending' end as final_status
from gold_transaction_facts f left join silver_payments p on f.transaction_id = p.transaction_id""")

Q["doc_paying_customers"] = with_base("""
select count(distinct customer_id) as paying_customers from silver_transactions
where status = 'success' and amount > 0""")

Q["doc_subscription_lifecycle"] = with_base(f"""
select subscription_id, customer_id, status, start_date, end_date,
  row_number() over w as lifecycle_seq,
  lead(start_date) over w as next_start_date,
  coalesce(coalesce(end_date, {AS_OF}) > lead(start_date) over w, false) as overlaps_next
from silver_subscriptions
window w as (partition by customer_id order by start_date, subscription_id)""")

Q["doc_mrr_movement"] = with_base(f"""
select customer_id, revenue_month, mrr, prev_mrr,
  case when prev_mrr is null then 'new' when mrr > prev_mrr then 'expansion'
       when mrr < prev_mrr then 'contraction' else 'flat' end as movement
from (
  select customer_id, revenue_month, mrr,
    case when lag(revenue_month) over w = revenue_month - interval 1 month then lag(mrr) over w end as prev_mrr
  from (select customer_id, revenue_month, cast(sum(monthly_price) as bigint) as mrr
        from mrr_expanded where status = 'active' group by 1, 2) m
  window w as (partition by customer_id order by revenue_month)
) x
union all
select customer_id, cast(revenue_month + interval 1 month as date), 0, mrr, 'churned'
from (select customer_id, revenue_month, cast(sum(monthly_price) as bigint) as mrr
      from mrr_expanded where status = 'active' group by 1, 2) m
where revenue_month + interval 1 month <= {AS_OF}
  and not exists (select 1 from mrr_expanded n where n.status = 'active' and n.customer_id = m.customer_id
                  and n.revenue_month = m.revenue_month + interval 1 month)""", MRR)

Q["doc_refund_linkage"] = with_base("""
select r.refund_id, r.transaction_id, coalesce(t.linked, false) as is_linked
from silver_refunds r
left join (select distinct transaction_id, true as linked from silver_transactions) t
  on r.transaction_id = t.transaction_id""")

EMAIL_STD = """case when position('@' in lower(trim(email))) > 0 then
  regexp_replace(regexp_replace(split_part(lower(trim(email)), '@', 1), '\\+.*$', ''), '\\.', '', 'g')
  || '@' || regexp_extract(lower(trim(email)), '@([^@]*)$', 1)
  else lower(trim(email)) end"""
Q["doc_email_standardize"] = with_base(f"""
select customer_id, email, {EMAIL_STD} as email_standardized, md5({EMAIL_STD}) as email_std_hash
from raw_customers""")

Q["doc_churn_classified"] = with_base("""
select c.end_date as churn_date, c.subscription_id, c.customer_id,
  case when pc.has_active then 'partial' else 'full' end as churn_type, pc.last_active_plan
from (select * from silver_subscriptions where status = 'canceled') c
left join (select customer_id, bool_or(status = 'active') as has_active,
             arg_max(plan_name, struct_pack(s := start_date, i := subscription_id))
               filter (where status = 'active') as last_active_plan
           from silver_subscriptions group by customer_id) pc
  on c.customer_id = pc.customer_id""")

# ---------------------------------------------------------------- triage
Q["triage_revenue_layers"] = with_base("""
select date, layer, count(*) as row_count from (
  select cast(created_at as date) as date, 'bronze_transactions' as layer from raw_transactions
  union all select cast(created_at as date), 'silver_transactions' from silver_transactions
  union all select cast(created_at as date), 'gold_transaction_facts' from gold_transaction_facts
  union all select cast(created_at as date), 'gold_transaction_facts_paid' from gold_transaction_facts where is_paid
  union all select revenue_date, 'gold_daily_revenue' from gold_daily_revenue
  union all select date, 'platinum_scorecard_daily' from scorecard_daily_base
) u group by 1, 2""")

Q["triage_refund_distribution"] = with_base("""
select length(cast(floor(refunded_amount) as varchar)) as integer_digits, count(*) as transactions,
  cast(sum(refunded_amount) as double) as total_refunded, cast(min(refunded_amount) as double) as min_refunded,
  cast(max(refunded_amount) as double) as max_refunded,
  round(quantile_cont(cast(refunded_amount as double), 0.5), 2) as median_refunded,
  round(quantile_cont(cast(refunded_amount as double), 0.95), 2) as p95_refunded
from gold_transaction_facts where refunded_amount > 0 group by 1""")

Q["triage_largest_refunds"] = with_base("""
select r.refund_id, r.transaction_id, cast(r.amount as double) as refund_amount, r.refund_reason, t.customer_id,
  cast(t.amount as double) as transaction_amount
from (select * from silver_refunds order by amount desc nulls last, refund_id limit 50) r
left join silver_transactions t on t.transaction_id = r.transaction_id""")

Q["triage_duplicate_refunds"] = with_base("""
select transaction_id, cast(amount as double) as amount, refund_reason, refunded_at, count(*) as copies
from silver_refunds group by transaction_id, amount, refund_reason, refunded_at having count(*) > 1""")

Q["triage_payment_retries"] = with_base("""
select attempt_number, count(*) as attempts,
  count(*) filter (where status = 'success') as successes,
  count(*) filter (where status != 'success') as failures,
  count(*) filter (where step != 1) as gap_rows,
  count(*) filter (where attempted_at < (select max(p2.attempted_at) from raw_payments p2
                                        where p2.transaction_id = x.transaction_id
                                          and p2.attempt_number = x.attempt_number - 1)) as out_of_order_rows
from (select transaction_id, attempt_number, status, attempted_at,
        attempt_number - lag(attempt_number) over w as step
      from raw_payments window w as (partition by transaction_id order by attempt_number, payment_id)) x
group by attempt_number""")

Q["triage_churn_distribution"] = with_base("""
select cast(date_trunc('month', end_date) as date) as churn_month, count(*) as canceled_subscriptions,
  count(distinct customer_id) as customers, count(*) - count(distinct customer_id) as duplicate_cancellations
from silver_subscriptions where status = 'canceled' and end_date is not null group by 1""")

Q["triage_window_completeness"] = with_base("""
select date, history_rows, cast(date - history_start as bigint) as history_span_days,
  coalesce(history_rows = 30 and cast(date - history_start as bigint) = 30, false) as is_complete
from (select date, count(*) over w as history_rows, min(date) over w as history_start
      from scorecard_daily_base window w as (order by date rows between 30 preceding and 1 preceding)) x""")

Q["triage_anomalies_complete_days"] = with_base(
    anomalies_sql("complete_days"),
    {"scorecard_daily": SCORECARD_DAILY,
     "complete_days": "select * from scorecard_daily where date < (select max(date) from scorecard_daily)"})

Q["layout_transaction_facts"] = Q["gold_transaction_facts"]
Q["layout_final_status"] = Q["doc_final_status"]
