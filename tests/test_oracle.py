"""Every SQL-checkable query equals its DuckDB oracle on the smallest dataset."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import duck, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "predicted_winner" in df.columns
