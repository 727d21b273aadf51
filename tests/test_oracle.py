"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

OWN = (entry.extracts, entry.records, entry.histories, entry.jobs)
QUERIES = {name: query for m in OWN for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in OWN for name, sql in m.ORACLE.items()}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name, QUERIES[name], ORACLE[name]) == ""


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["file", "rec_type", "actual", "declared", "status"]
    assert df.count() == 12
