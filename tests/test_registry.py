import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from stayline.registry.oracles import ORACLES
from stayline.registry.queries import REGISTERED

SF_DIR = os.environ.get("STAYLINE_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None


def test_every_query_has_sql():
    assert set(REGISTERED) == set(ORACLES)
    assert set(REGISTERED) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_returns_users(spark):
    found = entry(spark)
    assert found.count() == 14 and found.where("churn = 1").count() == 4
