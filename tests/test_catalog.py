"""Every registered query with an SQL twin gives the twin's rows."""

import pytest
from oracle import compare, duck

from tallyfold.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    assert compare(QUERIES[name](spark, FOLDER), ORACLES[name], con) == []


@pytest.mark.parametrize("name", ["daily_kmeans", "daily_elbow", "tree_importance", "svd_features"])
def test_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
