"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import entry
from windtally.plans.catalog import ORACLE_SQL, QUERIES

from conftest import SF_SMALL

FAST = sorted(n for n in QUERIES if not n.startswith("stream_"))


@pytest.fixture(scope="module")
def con():
    from tools.oracle_check import duck
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    from tools.oracle_check import compare
    r = compare(spark, name, QUERIES[name], ORACLE_SQL.get(name), SF_SMALL, con)
    assert r.get("values_match", True), r


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "rnk", "article_id", "n"]
    assert df.count() > 0
