"""Registered queries against their oracle SQL on the smallest tables.

Queries that write lakes or run streams take minutes together; set TIDEGRID_FULL=1 to include them.
"""

import os

import pytest

import __spark_entry__ as entry
from tools.oracle_check import difference, oracle

SF = "/root/testdata/sf0.001"
SLOW = ("job_", "stream_", "compact_", "retire_")
NAMES = [
    name
    for name in entry.oracle_sql()
    if os.environ.get("TIDEGRID_FULL") or not name.startswith(SLOW)
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_oracle(spark, con, name):
    assert difference(spark, con, name, SF) in (None, "no rows")


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 169 and df.columns[0] == "datetime"
    assert df.count() > 0
