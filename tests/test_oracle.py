"""Every registered query equals its independent DuckDB SQL (sf0.001)."""

import pytest

from marketlens.registry import oracle_sql, queries
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUERIES = queries()
SQL = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, info = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert ok, info


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert [r["Period"] for r in rows] == ["This Month", "Last Month"]
    assert all(r["active_users"] >= 0 for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    from tools.type_check import SPARK_TO_DUCK
    df = QUERIES[name](spark, SF_SMALL)
    st = {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, str(f.dataType)) for f in df.schema.fields}
    rel = con.sql(SQL[name])
    assert st == {n: str(t) for n, t in zip(rel.columns, rel.types)}
