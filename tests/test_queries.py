"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, connection, name):
    _, rows, wrong = compare.differences(spark, connection, FOLDER, name)
    assert wrong == []
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert row["fetched_traces"] == 1000 and row["fired_events"] > 0
