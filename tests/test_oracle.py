"""Every query against its SQL; ORACLE_SF_DIR selects another folder of tables."""

import os

import pytest

from __spark_entry__ import entry
from checks.compare import connect, differences
from checks.oracle import oracle_sql
from checks.queries import queries
from tests.conftest import SMALL

FOLDER = os.environ.get("ORACLE_SF_DIR", SMALL)


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, con, name):
    assert differences(spark, con, FOLDER, name) == []


def test_entry(spark):
    df = entry(spark)
    assert "low_stock_flg_wk" in df.columns
    assert df.count() > 0
