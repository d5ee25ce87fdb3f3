"""Every registered query against its DuckDB oracle on sf0.001 (the driver runs the same at sf0.01)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _keys():
    from __spark_entry__ import oracle_sql

    return list(oracle_sql())


@pytest.fixture(scope="module")
def duck():
    from compare_oracle import duck as make

    return make(SF)


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, duck, key):
    from compare_oracle import digest

    from __spark_entry__ import oracle_sql, queries

    df = queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.sql(oracle_sql()[key])
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(res.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(res.columns, drows)[0]


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
