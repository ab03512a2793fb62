"""Static seed tables (a handful of rows; broadcast on join)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from finspark.config import SUBSCRIPTION_PLANS

PLANS_SCHEMA = T.StructType([
    T.StructField("plan_name", T.StringType(), False),
    T.StructField("monthly_price", T.IntegerType(), False),
])


def subscription_plans(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUBSCRIPTION_PLANS, PLANS_SCHEMA)
