import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ambar.plans.check import connect, differences

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# These fit many models; what they are made of has tests of its own.
LONG = {"cv_auc", "flow_cv", "leakage_experiment", "random_search", "random_search_best", "random_search_cover"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG))
def test_equals_duckdb(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LONG))
def test_rows_without_sql(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert {r["split"] for r in entry(spark).collect()} == {"train", "test"}
