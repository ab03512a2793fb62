"""Imports every module that registers queries beyond the layer models."""

from finspark.operators import primitives  # noqa: F401
from finspark.operators import quality  # noqa: F401
from finspark.operators import compliance, insight  # noqa: F401
from finspark.operators import docmetrics, triage  # noqa: F401
from finspark.operators import retrieval  # noqa: F401
from finspark.operators import active_sets, ingest, kb_increment  # noqa: F401
from finspark.plans import layout  # noqa: F401
