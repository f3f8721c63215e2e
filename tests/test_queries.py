"""Every registered query against its DuckDB twin."""

import pytest
from support import SF

import __spark_entry__ as entry
import check_oracle
import driver_queries

NAMES = sorted(driver_queries.QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_its_twin(spark, name):
    good, note = check_oracle.compare(spark, SF, name)
    assert good, note


def test_every_query_has_a_twin():
    assert sorted(driver_queries.ORACLE) == NAMES
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


def test_entry_gives_the_enriched_contract(spark):
    assert len(entry.entry(spark).columns) == 35
