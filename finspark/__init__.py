"""finspark: a Spark-native finance analytics pipeline.

Layers (raw -> bronze -> silver -> gold -> platinum), data-quality and
compliance checks, a daily finance summary and chunk/vector retrieval, all
expressed as DataFrame / SQL plans that Catalyst optimises and AQE re-plans.
"""

from finspark.config import PipelineConfig
from finspark.plans.pipeline import Pipeline
from finspark.session import get_spark

__all__ = ["Pipeline", "PipelineConfig", "get_spark"]
