from finspark.sources.fixtures import ENTITY_BUILDERS
from finspark.sources.seeds import subscription_plans
from finspark.sources.tables import read_table, table_path

__all__ = ["ENTITY_BUILDERS", "subscription_plans", "read_table", "table_path"]
