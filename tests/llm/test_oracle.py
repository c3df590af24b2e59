"""Queries with SQL equal it on the small tables."""
import duckdb
import pytest

from tests.conftest import SF_SMALL
from windtally.llm.catalog import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF_SMALL}/{t}.parquet'")
    cur = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    got = QUERIES[name](spark, SF_SMALL).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(cur.fetchall())
