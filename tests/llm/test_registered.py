"""The registered queries of the subpackage against their DuckDB twins, and what the registry holds."""

import pytest

import __spark_entry__ as entry
import check_oracle
import corpus_pipeline
from tollgate.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_its_twin(spark, name):
    good, note = check_oracle.compare(spark, SF, name)
    assert good, note


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
    assert [int(name[2:].split("_")[0]) for name in queries.QUERIES] == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5
