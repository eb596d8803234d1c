"""Every registered query against its DuckDB oracle on the smallest data."""

import pytest

from quarry.plans.oracle_sql import ORACLE
from quarry.plans.registry import QUERIES

from oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    assert compare(spark, con, key, SF, verbose=True)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() > 0
