"""Every registered query against its oracle SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry_module

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


@pytest.mark.parametrize("name", ["sorted_patients", "sorted_codes", "index_one_patient", "index_merge", "index_reuse"])
def test_whole_tables_beyond_the_smallest(spark, name):
    """Results that a cut of a few hundred rows would not show on the smallest tables."""
    larger = SF_DIR.replace("0.001", "0.01")
    assert oracle.compare(QUERIES[name](spark, larger), oracle.connect(larger), ORACLES[name]) == []
