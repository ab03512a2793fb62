"""Governance views over silver: ``admin`` (all columns) and ``analytics``
(restricted projections).  As models they are projections; as catalog
objects they are created by :func:`finspark.plans.catalog.create_views`."""

from __future__ import annotations

from pyspark.sql import DataFrame

from finspark.plans.pipeline import Pipeline, model

ENTITIES = ("accounts", "customers", "payments", "refunds", "subscriptions", "transactions")

ANALYTICS_COLUMNS: dict[str, list[str] | None] = {
    "customers": ["customer_id", "email_hash", "phone_hash", "full_name_hash", "device_id", "created_at",
                  "ingestion_date"],
    "accounts": None,  # select *
    "payments": ["payment_id", "transaction_id", "final_payment_status", "ingestion_date"],
    "refunds": ["refund_id", "transaction_id", "amount", "refunded_at", "ingestion_date"],
    "subscriptions": ["subscription_id", "customer_id", "status", "start_date", "ingestion_date"],
    "transactions": ["transaction_id", "account_id", "customer_id", "status", "settled_at", "ingestion_date"],
}


def _register(entity: str) -> None:
    @model(f"admin_{entity}")
    def _admin(p: Pipeline) -> DataFrame:
        return p.ref(f"silver_{entity}").select("*")

    @model(f"analytics_{entity}")
    def _analytics(p: Pipeline) -> DataFrame:
        cols = ANALYTICS_COLUMNS[entity]
        s = p.ref(f"silver_{entity}")
        return s.select("*") if cols is None else s.select(*cols)


for _e in ENTITIES:
    _register(_e)
