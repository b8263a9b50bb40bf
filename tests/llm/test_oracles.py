"""Queries that SQL expresses, against DuckDB on the same tables."""

import pytest

from marketlens.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.common import SMALL, duck


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equal_to_sql(spark, name):
    ours = QUERIES[name](spark, SMALL).toPandas()
    theirs = duck(ORACLE_SQL[name])
    key = next(k for k in (["slot"], ["part", "filter_order", "step"], ["conv_id", "depth"], ["doc_id"], ["page_id"]) if set(k) <= set(ours))
    assert sorted(ours) == sorted(theirs)
    ours = ours.sort_values(key).reset_index(drop=True)[sorted(ours)]
    theirs = theirs.sort_values(key).reset_index(drop=True)[sorted(ours)]
    assert len(ours) and ours.equals(theirs.astype(ours.dtypes))
