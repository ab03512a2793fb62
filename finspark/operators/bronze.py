"""Raw and bronze layers: raw entities, bronze = raw columns + load timestamp.

Bronze does no cleaning by contract.  Incremental loads go through
:func:`finspark.operators.macros.incremental_filter` and
:func:`finspark.operators.macros.upsert` (see :mod:`finspark.operators.ingest`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finspark.plans.pipeline import Pipeline, model
from finspark.sources.fixtures import ENTITY_BUILDERS

ENTITY_KEYS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "transactions": "transaction_id",
    "payments": "payment_id",
    "subscriptions": "subscription_id",
    "refunds": "refund_id",
}


def with_load_time(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp().cast("timestamp_ntz"))


def _register(entity: str) -> None:
    @model(f"raw_{entity}")
    def _raw(p: Pipeline) -> DataFrame:
        return ENTITY_BUILDERS[entity](p.spark, p.sf_dir)

    @model(f"bronze_{entity}")
    def _bronze(p: Pipeline) -> DataFrame:
        return with_load_time(p.raw(entity), "bronze_loaded_at")


for _entity in ENTITY_BUILDERS:
    _register(_entity)
