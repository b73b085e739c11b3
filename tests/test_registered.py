"""Every registered query next to its SQL, on the smallest tables."""

import re

import pytest
from check import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", [name for name in queries() if name in ORACLE])
def test_matches_sql(spark, database, name):
    assert compare(queries()[name](spark, SF_DIR), database, oracle_sql()[name]) == ""


def test_only_model_results_lack_sql():
    assert set(QUERIES) - set(oracle_sql()) == {
        "model_metrics",
        "confusion",
        "roc_points",
        "feature_importance",
        "batch_score",
    }
    assert set(oracle_sql()) <= set(queries())


def test_names():
    assert all(re.fullmatch(r"[a-z][a-z_]+", name) for name in QUERIES)
    assert set(QUERIES) <= set(queries())
