"""Every registered query against its SQL twin on the smallest tables."""

from pathlib import Path

import pytest

import check_oracle
from wardline.plans.oracle import ORACLE_SQL
from wardline.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert check_oracle.compare(spark, con, FOLDER, name, QUERIES[name], ORACLE_SQL[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())
