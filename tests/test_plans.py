"""Plan-shape guards for the large-data properties recorded in PLANS.md (broadcast off, AQE off)."""

import re

import pytest

from hitroll import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.fixture
def large_shape(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def plan(spark, name):
    text = Q.REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().treeString()
    return re.sub(r"#\d+L?", "", text)                 # drop expression ids


def test_flagship_prunes_columns_and_aggregates_before_shuffles(large_shape):
    p = plan(large_shape, "dataset_summary")
    schemas = set(re.findall(r"ReadSchema: (struct<[^ ]*>)", p))
    assert schemas == {"struct<o_orderkey:bigint,o_orderpriority:string>",
                       "struct<l_orderkey:bigint,l_quantity:double>"}
    assert p.count("Exchange") == 3                      # hits, universe, dataset level
    assert "partial_avg(score)" in p and "partial_avg(mean_score)" in p


def test_map_explode_builds_maps_once(large_shape):
    p = plan(large_shape, "generated_rows")
    assert "Filter (size(" not in p                      # no inferred copy of the map build
    assert p.count("collect_list(struct(") == 2          # partial and final, once


def test_rejected_structures_are_anti_joined_from_one_exchange(large_shape):
    p = plan(large_shape, "json_code_summary")
    assert "Window" not in p and "LeftAnti" in p


def test_search_of_a_one_block_library_needs_no_window(large_shape):
    p = plan(large_shape, "label_top_k")
    assert "Window" not in p
