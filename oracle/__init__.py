"""Independent DuckDB statements for the differential check."""

from oracle import docs_sql, insight_sql, io_sql, kb_sql, primitives_sql, quality_sql  # noqa: F401  (register into Q)
from oracle.duckdb_sql import Q as ORACLE

__all__ = ["ORACLE"]
