"""Every registered query with an oracle matches DuckDB on the smoke tables."""

import pytest

from conftest import SMOKE
import __spark_entry__ as E
from tools.compare import compare, duck

ORACLES = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    line, ok = compare(spark, con, name, QUERIES[name], ORACLES[name], SMOKE)
    assert ok, line


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert {"metric", "current", "previous", "direction"} <= set(df.columns)
