"""Publishing models to the session catalog.

``publish`` registers models as temporary views named ``<model>`` (the
layer is kept alongside), so SQL users and catalog listings
(``spark.catalog.listTables`` / ``listColumns``) see them.  ``materialize``
writes models as tables in a named database for a durable run.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from finspark.plans.pipeline import Pipeline

ENTITIES = ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")

LAYER_MODELS: dict[str, tuple[str, ...]] = {
    "bronze": tuple(f"bronze_{e}" for e in ENTITIES),
    "silver": tuple(f"silver_{e}" for e in ENTITIES),
    "gold": ("gold_transaction_facts", "gold_daily_revenue", "gold_monthly_revenue", "gold_mrr", "gold_arr",
             "gold_churn", "gold_customer_metrics", "gold_refund_rate", "gold_failed_payment_rate",
             "gold_cohort_retention"),
    "platinum": ("platinum_finance_exec_scorecard_daily", "platinum_finance_exec_scorecard_monthly",
                 "platinum_anomalies_daily"),
    "admin": tuple(f"admin_{e}" for e in ENTITIES),
    "analytics": tuple(f"analytics_{e}" for e in ENTITIES),
}


def publish(p: Pipeline, layers=("gold", "platinum")) -> list[tuple[str, str]]:
    """Register each model of the layers as a temp view; returns (layer, name)."""
    out = []
    for layer in layers:
        for m in LAYER_MODELS[layer]:
            p.ref(m).createOrReplaceTempView(m)
            out.append((layer, m))
    return out


def materialize(spark: SparkSession, p: Pipeline, layers=("silver", "gold", "platinum"),
                fmt: str = "parquet") -> list[str]:
    """Write models as managed tables ``<layer>.<model>`` (overwrite) and
    create the admin / analytics views over the silver tables."""
    written = []
    for layer in layers:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for m in LAYER_MODELS[layer]:
            p.ref(m).write.mode("overwrite").format(fmt).saveAsTable(f"{layer}.{m}")
            written.append(f"{layer}.{m}")
    if "silver" in layers:
        create_views(spark)
    return written


def create_views(spark: SparkSession) -> None:
    """Governance views over materialised silver tables."""
    from finspark.operators.views import ANALYTICS_COLUMNS
    spark.sql("CREATE DATABASE IF NOT EXISTS admin")
    spark.sql("CREATE DATABASE IF NOT EXISTS analytics")
    for e in ENTITIES:
        spark.sql(f"CREATE OR REPLACE VIEW admin.admin_{e} AS SELECT * FROM silver.silver_{e}")
        cols = ANALYTICS_COLUMNS[e]
        sel = "*" if cols is None else ", ".join(cols)
        spark.sql(f"CREATE OR REPLACE VIEW analytics.analytics_{e} AS SELECT {sel} FROM silver.silver_{e}")
