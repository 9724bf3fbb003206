"""Queries against their SQL twins on the smallest data; set TROLLEY_ALL_QUERIES=1 for all."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from testbed.compare import differences, duck

CHOSEN = (
    "clean_transactions",
    "clean_customers",
    "clean_articles",
    "ranking_interactions",
    "two_tower_interactions",
    "user_features",
    "item_features",
    "temporal_split",
    "stats_numeric",
    "negative_samples",
    "vec_cosine_topk",
    "binary_metrics",
)
NAMES = sorted(oracle_sql()) if os.environ.get("TROLLEY_ALL_QUERIES") else CHOSEN


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


@pytest.mark.parametrize("name", NAMES)
def test_equal_to_sql(spark, small, connection, name):
    assert differences(queries()[name](spark, small), connection, oracle_sql()[name]) is None


def test_flagship(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
