"""Registered queries against their SQL, and the driver's view of them."""

import __spark_entry__ as E
import duckdb
import pytest
from conftest import SF_SMALL
from finspark.llm.queries import QUERIES
from finspark.llm.queries_sql import ORACLE_SQL

TABLES = ("documents", "embeddings", "benchmark", "labels", "conversations")


def test_one_query_per_operator_and_the_pipeline():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[key](spark, SF_SMALL)
    cursor = con.execute(ORACLE_SQL[key])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, df.select(*names).toPandas().itertuples(index=False, name=None))) == sorted(
        map(repr, cursor.df().itertuples(index=False, name=None)))
