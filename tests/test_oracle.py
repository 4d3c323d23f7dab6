"""Every registered query against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402
from stopflow.plans.queries import QUERIES as CORE  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

# the queries of optional subpackages have tests of their own
QUERIES = {k: v for k, v in entry.queries().items() if k in CORE}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    if key not in ORACLE:
        assert rows, f"{key} returned no rows"
        return
    res = con.execute(ORACLE[key])
    a, ac = rows_of(df.columns, rows)
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert sorted(a, key=repr) == sorted(b, key=repr)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["station_code", "station_name", "total_stops", "distinct_trains"]
    assert df.count() > 0
