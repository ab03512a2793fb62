"""DuckDB oracle for the relational-primitive queries."""

from __future__ import annotations

from oracle.duckdb_sql import AS_OF, MRR_EXPANDED, Q, with_base

SUCCESS = "(select * from silver_transactions where status = 'success')"
ARR_CASE = ("case when plan_name = 'basic' then 10 when plan_name = 'pro' then 30 "
            "when plan_name = 'enterprise' then 100 else 0 end")
PLANS = "(select * from (values ('basic', 29), ('pro', 79), ('enterprise', 199)) v(plan_name, monthly_price))"

Q["p_projection"] = with_base("""
select transaction_id, customer_id, account_id, cast(amount as double) as transaction_amount,
  status as transaction_status, created_at from silver_transactions""")

Q["p_case"] = with_base("""
select account_id, status,
  case when status = 'closed' then 'closed' when status = 'suspended' then 'inactive' else 'active' end
    as normalized_status
from raw_accounts""")

Q["p_filter_eq"] = with_base(f"""
select subscription_id, customer_id, plan_name, {ARR_CASE} as arr_monthly_price
from silver_subscriptions where status = 'active'""")

Q["p_filter_range"] = with_base("""
select transaction_id, customer_id, cast(refunded_amount as double) as refunded_amount
from gold_transaction_facts where refunded_amount > 0""")

Q["p_union_all"] = with_base(f"""
select transaction_id, 'charge' as entry_type, cast(created_at as date) as entry_date,
  cast(amount as double) as amount from {SUCCESS} t
union all
select transaction_id, 'refund', refunded_at, cast(-amount as double) from silver_refunds""")

Q["join_inner_broadcast"] = with_base(f"""
select s.subscription_id, s.plan_name, p.monthly_price
from silver_subscriptions s join {PLANS} p on s.plan_name = p.plan_name""")

Q["join_left"] = with_base("""
select t.transaction_id, t.status, p.payment_id, p.final_payment_status
from silver_transactions t left join silver_payments p on t.transaction_id = p.transaction_id""")

Q["join_left_fanout"] = with_base(f"""
select t.transaction_id, cast(t.amount as double) as amount, r.refund_id, cast(r.amount as double) as refund_amount
from {SUCCESS} t left join silver_refunds r on t.transaction_id = r.transaction_id""")

Q["join_lateral_series"] = with_base("select subscription_id, status, revenue_month from mrr_expanded",
                                     {"mrr_expanded": MRR_EXPANDED})

Q["agg_sum"] = with_base("""
select customer_id, cast(sum(amount) as double) as total_amount from silver_transactions group by customer_id""")

Q["agg_count"] = with_base("""
select payment_method, count(*) as payment_count from silver_payments group by payment_method""")

Q["agg_count_filter"] = with_base("""
select payment_method, count(*) as attempt_count, count(*) filter (where status != 'success') as failed_count
from raw_payments group by payment_method""")

Q["agg_count_case"] = with_base("""
select customer_id, count(case when is_paid = true then 1 end) as paid_transaction_count,
  count(case when is_paid = false then 1 end) as unpaid_transaction_count
from gold_transaction_facts group by customer_id""")

Q["agg_count_distinct"] = with_base("""
select merchant_name, count(distinct customer_id) as distinct_customers,
  count(distinct account_id) as distinct_accounts
from silver_transactions group by merchant_name""")

Q["agg_min"] = with_base(f"""
select customer_id, min(created_at) as first_paid_at, cast(min(amount) as double) as smallest_amount
from {SUCCESS} t group by customer_id""")

Q["agg_max"] = with_base(" union all ".join(
    f"select 'bronze_{e}' as table_name, max(ingestion_date) as max_ingestion_date from raw_{e}"
    for e in ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")))

Q["agg_distinct"] = with_base("""
select customer_id from silver_accounts where normalized_status = 'active' group by customer_id""")

Q["dedupe_latest"] = with_base("""
select transaction_id, account_id, customer_id, cast(amount as double) as amount, currency, merchant_name, status,
  created_at, settled_at, ingestion_date, card_last_four, device_id, rn
from (select *, row_number() over (partition by transaction_id order by
  ingestion_date desc nulls last, created_at desc nulls last, amount desc nulls last, status desc nulls last,
  settled_at desc nulls last, account_id desc nulls last, customer_id desc nulls last, currency desc nulls last,
  merchant_name desc nulls last, card_last_four desc nulls last, device_id desc nulls last) as rn
  from raw_transactions) x where rn = 1""")

Q["win_moving_avg"] = with_base("""
select date, cast(net_revenue as double) as net_revenue,
  round(cast(avg(net_revenue) over (order by date rows between 6 preceding and current row) as double), 4)
    as net_revenue_7d_avg
from scorecard_daily_base""")

Q["win_lag"] = with_base("""
select date, cast(net_revenue as double) as net_revenue,
  cast(lag(net_revenue, 1) over (order by date) as double) as prev_day_net_revenue,
  cast(net_revenue - lag(net_revenue, 7) over (order by date) as double) as net_revenue_wow_change
from scorecard_daily_base""")

Q["win_trailing_avg"] = with_base("""
select date, cast(net_revenue as double) as net_revenue,
  round(avg(cast(net_revenue as double)) over (order by date rows between 30 preceding and 1 preceding), 4)
    as net_revenue_mean_30
from scorecard_daily_base""")

Q["win_trailing_stddev"] = with_base("""
select date, cast(net_revenue as double) as net_revenue,
  round(stddev_samp(cast(net_revenue as double)) over (order by date rows between 30 preceding and 1 preceding), 4)
    as net_revenue_std_30
from scorecard_daily_base""")

Q["sort_asc"] = with_base("""
select revenue_date, cast(net_revenue as double) as net_revenue from gold_daily_revenue
order by revenue_date asc nulls last""")

Q["topk_latest"] = with_base("""
select revenue_date, cast(net_revenue as double) as net_revenue from gold_daily_revenue
order by revenue_date desc limit 2""")

Q["fn_md5"] = with_base("""
select customer_id, email, md5(lower(trim(email))) as email_hash, md5(phone) as phone_hash from raw_customers""")

Q["fn_date"] = with_base("""
select transaction_id, created_at, cast(created_at as date) as created_date from silver_transactions""")

Q["fn_month"] = with_base("""
select transaction_id, cast(date_trunc('month', created_at) as date) as month,
  cast(date_trunc('month', settled_at) as date) as settled_month
from silver_transactions""")

Q["fn_months_between"] = with_base(f"""
select account_id, opened_at, closed_at,
  cast(datediff('month', opened_at, coalesce(closed_at, {AS_OF})) as int) as months_open
from silver_accounts""")

Q["fn_month_series"] = with_base(f"""
select subscription_id, start_date, effective_end_date,
  cast(len(ms) as bigint) as months_billed,
  cast(date_trunc('month', list_min(ms)) as date) as first_month,
  cast(date_trunc('month', list_max(ms)) as date) as last_month
from (
  select subscription_id, start_date, coalesce(end_date, {AS_OF}) as effective_end_date,
    generate_series(cast(start_date as timestamp), cast(coalesce(end_date, {AS_OF}) as timestamp),
      interval '1 month') as ms
  from silver_subscriptions
) s""")

Q["fn_coalesce"] = with_base(f"""
select subscription_id, end_date, coalesce(end_date, {AS_OF}) as effective_end_date from silver_subscriptions""")

Q["fn_safe_ratio"] = with_base("""
select merchant_name, paid_count,
  round(case when paid_amount = 0 then null else refunded_amount * 1.0 / paid_amount end, 6) as refund_rate
from (
  select t.merchant_name,
    sum(case when f.is_paid then f.transaction_amount else 0 end) as paid_amount,
    sum(case when f.is_paid then f.refunded_amount else 0 end) as refunded_amount,
    count(case when f.is_paid then 1 end) as paid_count
  from gold_transaction_facts f join silver_transactions t on f.transaction_id = t.transaction_id
  group by t.merchant_name
) g""")

Q["incremental_filter"] = """
select event_id, ts, user_id, event_type, value, cast(ts as date) as ingestion_date
from events
where cast(ts as date) >= (select max(cast(ts as date)) from events where ts < TIMESTAMP '2024-01-16 00:00:00')"""

Q["seed_subscription_plans"] = with_base(f"""
select p.plan_name, p.monthly_price, coalesce(s.subscriptions, 0) as subscriptions
from {PLANS} p left join (select plan_name, count(*) as subscriptions from silver_subscriptions group by plan_name) s
  on p.plan_name = s.plan_name""")
