"""Plan-shape tests: the scale properties the design relies on."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from hazardpanel import fixtures as fx
from hazardpanel.operators.dedup import dedup_keep_first
from hazardpanel.operators.prefix import running_totals
from hazardpanel.operators.spatial import assign_region
from hazardpanel.operators.windows import topk_per_group
from tests.conftest import SF_SMALL


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("key", ["fused_panel", "daily_refresh", "stage_funnel", "best_variant",
                                 "metric_delta", "window_plan", "dryness_features"])
def test_no_nested_loop_or_cartesian(spark, key):
    plan = _final_plan(ent.queries()[key](spark, SF_SMALL))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert not re.search(r"BatchEvalPython|ArrowEvalPython", plan)


def test_dedup_combines_before_shuffle(spark):
    det = fx.detections(spark, SF_SMALL)
    plan = dedup_keep_first(det, ["latitude", "longitude", "acq_date", "acq_time", "satellite"],
                            ["pri", "event_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_topk_limits_before_shuffle(spark):
    df = fx.daily_scored(spark, SF_SMALL)
    plan = _final_plan(topk_per_group(df, "day", "score", 8, "event_id"))
    first_exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[first_exchange:], "partial group limit must sit below the exchange"


def test_points_are_not_shuffled_for_placement(spark):
    pts = fx.detections(spark, SF_SMALL).select("event_id", "pri", "latitude", "longitude")
    plan = _final_plan(assign_region(pts, fx.edges(spark, SF_SMALL)))
    # the only exchanges build the (small) cell table that is broadcast
    assert "BroadcastHashJoin" in plan
    point_side = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning(event_id" not in point_side


def test_running_totals_do_not_use_a_single_partition_window(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("double").alias("k"), F.lit(1).alias("v"))
    out = running_totals(df, "k", ["v"], n_ranges=8)
    plan = _final_plan(out)
    windows = re.findall(r"Window \[[^\n]*", plan)
    data_windows = [w for w in windows if "k#" in w.partition("sum(")[2]]
    assert data_windows and all("_range" in w.rpartition("], [")[0] for w in data_windows)   # partitioned by range
