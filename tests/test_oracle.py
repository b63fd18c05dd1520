"""Every registered query against its SQL, on the smallest tables."""

import pytest
from conftest import TESTDATA

import __spark_entry__ as registered
from workload import compare


@pytest.fixture(scope="module")
def connection():
    return compare.oracle(TESTDATA)


def test_every_oracle_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_equals_oracle(spark, connection, name):
    good, note = compare.compare(spark, connection, TESTDATA, name)
    assert good, note
    assert "types" not in note, note
