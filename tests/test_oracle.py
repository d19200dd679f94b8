"""Every registered query against its DuckDB twin."""

import pytest

import __spark_entry__ as entrypoint
import check
from workload import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, sf_dir, name):
    good, note = check.compare(spark, con, name, sf_dir)
    assert good, note


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entrypoint.oracle_sql()) <= set(entrypoint.queries())
