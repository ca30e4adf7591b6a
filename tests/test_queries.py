"""Every registered query against its SQL, over the whole small tables."""

import pytest

from compare import connect, difference

from tidemark.plans import all_checks, all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, CHECKS = all_queries(), all_checks()
SLOW = {"T10_rf_classifier", "T13_cross_validation", "T14_feature_importance"}  # see test_models


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    assert difference(spark, con, FOLDER, QUERIES[name], CHECKS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS) - SLOW))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
