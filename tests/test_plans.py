"""Plan-shape checks: the properties the scale design relies on."""

import pytest

from sightline.plans import QUERIES
from tests.conftest import SF_SMALL


def plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_anywhere(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name,key", [("running_totals", "_sl_bucket"), ("flow_matrix", "_sl_bucket"),
                                      ("stays_and_dwell", "_sl_bucket"), ("asof_latest_frame", "_sl_bk"),
                                      ("iou_pairs", "_cx"), ("peak_occupancy", "_sl_bucket")])
def test_hot_keys_are_split_before_the_window_or_join(spark, name, key):
    assert f"hashpartitioning(" in plan(spark, name)
    exchanges = [line for line in plan(spark, name).splitlines() if "Exchange hashpartitioning" in line]
    assert any(key in line for line in exchanges)


def test_exact_percentiles_count_first_and_rank_by_bucket(spark):
    p = plan(spark, "latency_by_node")
    assert "partial_count" in p and "SinglePartition" not in p
    assert any("_sl_bucket" in line for line in p.splitlines() if "Exchange hashpartitioning" in line)


@pytest.mark.parametrize("name", ["retain_last_n", "shed_newest", "shed_oldest", "embedding_topk"])
def test_top_n_has_partial_limit(spark, name):
    assert "WindowGroupLimit" in plan(spark, name)


@pytest.mark.parametrize("name", ["people_per_camera_hour", "ground_heatmap", "detections_per_frame",
                                  "latest_per_camera", "person_last_seen"])
def test_aggregates_are_partial(spark, name):
    p = plan(spark, name)
    assert "partial_" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "history_scan_pruned")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p
    p = plan(spark, "class_filter")
    assert "l_tax" not in p and "l_returnflag" not in p


def test_only_bounded_explicit_broadcast(spark):
    # the class dimension is the one explicit broadcast; it has 3 rows
    p = plan(spark, "class_name_lookup")
    assert "BroadcastExchange" in p
