"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from checks.compare import differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# Registered by a subpackage with tests of its own.
OPERATOR = re.compile(r"op\d+_|pipeline$")
# Queries whose plans change when keys are hot.
SKEWED = [
    "daily_stats", "monthly_history_ranked", "visitor_profile", "peer_rank", "normalize_bridge", "upsert_default_key",
    "append_new_keys", "replace_value_sets", "cascade_delete", "assign_keys", "spatial_inner", "spatial_left",
    "globe_within_distance", "globe_nearest_places",
    "build_cuisines", "build_long_reviews", "build_michelin", "external_images", "graph_edges_bag", "knn_exact",
    "recommend_batch", "recent_restaurants",
]


def test_every_query_has_an_oracle():
    own = {n for n in QUERIES if not OPERATOR.match(n)}
    assert own <= ORACLES.keys() <= QUERIES.keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and not OPERATOR.match(n)])
def test_query(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), FOLDER, ORACLES[name]) is None


@pytest.mark.parametrize("name", SKEWED)
def test_query_with_hot_keys(spark, many_hot_keys, name):
    assert differences(QUERIES[name](spark, FOLDER), FOLDER, ORACLES[name]) is None


def test_most_orders_have_their_items_replaced(spark):
    rows = QUERIES["bucket_replace_groups"](spark, FOLDER)
    replaced = rows.where("l_linenumber = 0").select("l_orderkey").distinct().count()
    kept = rows.where("l_linenumber > 0").select("l_orderkey").distinct().count()
    assert replaced > kept > 0
