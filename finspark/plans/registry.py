"""Named, checkable queries: ``name -> (spark, sf_dir) -> DataFrame``.

Model queries drop audit timestamps, render decimals as DOUBLE and round
floating results at a fixed precision (ratios 6 dp; window averages,
baselines and z-scores 4 dp) so they compare exactly across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finspark.config import FIXTURE_AS_OF, PipelineConfig
from finspark.plans.pipeline import Pipeline, for_output

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def round_columns(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double"), spec[c]).alias(c) if c in spec else F.col(c)
                       for c in df.columns])


def pipeline(spark: SparkSession, sf_dir: str, config: PipelineConfig | None = None) -> Pipeline:
    """The pipeline of the registered queries: the fixtures' run date unless a config is given."""
    return Pipeline(spark, sf_dir, config or PipelineConfig(as_of=FIXTURE_AS_OF))


def model_query(key: str, model_name: str, rounding: dict[str, int] | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = for_output(pipeline(spark, sf_dir).ref(model_name))
        return round_columns(df, rounding or {})
    QUERIES[key] = run


ENTITIES = ("customers", "accounts", "transactions", "payments", "subscriptions", "refunds")
for _e in ENTITIES:
    model_query(f"bronze_{_e}", f"bronze_{_e}")
    model_query(f"silver_{_e}", f"silver_{_e}")
    model_query(f"view_admin_{_e}", f"admin_{_e}")
    model_query(f"view_analytics_{_e}", f"analytics_{_e}")

for _m in ("gold_transaction_facts", "gold_daily_revenue", "gold_monthly_revenue", "gold_mrr", "gold_arr",
           "gold_churn", "gold_customer_metrics"):
    model_query(_m, _m)
model_query("gold_refund_rate", "gold_refund_rate", {"refund_rate": 6})
model_query("gold_failed_payment_rate", "gold_failed_payment_rate", {"failed_payment_rate": 6})
model_query("gold_cohort_retention", "gold_cohort_retention", {"retention_rate": 6})
model_query("platinum_scorecard_daily", "platinum_finance_exec_scorecard_daily",
            {"refund_rate": 6, "failed_payment_rate": 6, "net_revenue_7d_avg": 4})
model_query("platinum_scorecard_monthly", "platinum_finance_exec_scorecard_monthly", {"refund_rate": 6})
model_query("platinum_anomalies_daily", "platinum_anomalies_daily",
            {"metric_value": 6, "baseline_value": 4, "z_score": 4})


def load_all() -> dict[str, QueryFn]:
    """Import every operator module that registers queries."""
    from finspark.operators import queries_extra  # noqa: F401
    return QUERIES
