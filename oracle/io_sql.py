"""DuckDB oracle for loads, sinks and the streaming ingest."""

from __future__ import annotations

from oracle.duckdb_sql import BRONZE_COLUMNS, Q, _dn, with_base

TX = BRONZE_COLUMNS["transactions"]

Q["src_csv_scan"] = with_base(f"select {TX} from raw_transactions")

KEYS = {e: cols.split(",")[0] for e, cols in BRONZE_COLUMNS.items()}
for _e, _cols in BRONZE_COLUMNS.items():
    Q[f"src_csv_{_e}"] = with_base(f"select {_cols} from raw_{_e}")
Q["src_csv_quarantine"] = with_base("\nunion all ".join(
    f"select '{e}' as entity, {k} || ',cut off' as line from raw_{e} where {k} like '%7'" for e, k in KEYS.items()))

Q["bronze_upsert"] = with_base(f"""
select {TX} from (
  select * from first_load
  where transaction_id not in (select transaction_id from batch)
  union all select * from batch
) u""", {
    "first_load": "select * from raw_transactions where ingestion_date < DATE '1998-01-01'",
    "batch": "select * from raw_transactions where ingestion_date >= (select max(ingestion_date) from first_load)",
})

Q["stream_bronze_ingest"] = with_base(f"""
select {TX} from (
  select * from drop1 where transaction_id not in (select transaction_id from drop2)
  union all select * from drop2
) u""", {
    "drop1": "select * from raw_transactions where ingestion_date < DATE '1998-01-01'",
    "drop2": "select * from raw_transactions where ingestion_date >= DATE '1998-01-01'",
})

Q["stream_latest_state"] = with_base(f"""
select {TX} from (select *, row_number() over (partition by transaction_id order by
  {_dn('ingestion_date, created_at, amount, status, settled_at, account_id, customer_id, currency, merchant_name, card_last_four, device_id')}) as rn
  from raw_transactions) x where rn = 1""")

Q["stream_event_counts"] = """
select cast(date_trunc('day', ts) as date) as day, event_type, count(*) as events
from events group by 1, 2"""
