"""Every registered query against its SQL twin, over the whole smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests import oracle

SF = os.environ.get("ORACLE_SF_DIR", f"{oracle.TESTDATA}/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    if name in entry.oracle_sql():
        assert oracle.compare(df, con, entry.oracle_sql()[name]) == ""
    else:
        assert df.collect()


def test_entry_gives_warnings(spark):
    assert set(entry.entry(spark).columns) >= {"id", "title", "warning_level", "affected_location"}
