"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import aggregates, filters, joins, serving, windows
from roadpulse.plans import detection, hourly
from workload import inputs as I


def plan(df):
    """The plan as first made, before any adaptive change."""
    return df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Number of hash shuffles in the plan before it runs."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", text))


NATIVE = {
    "live": lambda s, d: I.live_hours(s, d),
    "hourly": lambda s, d: I.hourly_totals(s, d),
    "by type": lambda s, d: I.hourly_by_type(s, d),
    "snapshot": lambda s, d: aggregates.network_summary(I.snapshot(s, d)),
    "events": lambda s, d: detection.tracked_events(I.raw_detections(s, d), I.cameras(s)),
    "smooth": lambda s, d: windows.smooth_speed(I.located(s, d)),
    "timeline": lambda s, d: serving.type_timeline(I.hourly_by_type(s, d)),
}


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_and_no_cross_join(spark, small, name):
    text = plan(NATIVE[name](spark, small))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_live_windows_reduce_before_the_shuffle_and_do_not_expand(spark, small):
    df = aggregates.live_windows(filters.valid_live(I.detections(spark, small)), time="ts")
    text = plan(df)
    assert "Expand" not in text
    assert re.search(r"HashAggregate.*partial_avg", text)
    assert "SortAggregate" not in text
    assert exchanges(df) == 1


def test_totals_need_no_type_and_two_shuffles(spark, small):
    df = hourly.totals(I.detections(spark, small))
    assert exchanges(df) == 2
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan(df)).group(1)
    assert "props" not in scan


def test_cameras_are_broadcast_by_their_own_size(spark, small):
    text = plan(filters.in_roi(I.raw_detections(spark, small), I.cameras(spark)))
    assert "BroadcastHashJoin" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(filters.in_roi(I.raw_detections(spark, small), I.cameras(spark)))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_range_scan_reaches_the_file(spark, small):
    from workload.intake import src_table_scan

    text = plan(src_table_scan(spark, small))
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "props" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)


def test_tail_is_cut_before_the_shuffle(spark, small):
    history = aggregates.camera_history(I.hourly_by_type(spark, small))
    assert "WindowGroupLimit" in plan(serving.tail_intervals(history))


def test_top_lists_use_a_bounded_heap(spark, small):
    assert "TakeOrderedAndProject" in plan(serving.route_cards(I.snapshot(spark, small)))


def test_without_long_tracks_one_window_pass_remains(spark, small):
    df = windows.endpoint_speed(I.located(spark, small))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Union" not in final and "Join" not in final.replace("BroadcastHashJoin [source_id", "")
    assert len(re.findall(r"^\W*\*?\(?\d*\)? ?Window ", final, re.M)) <= 2


def test_upsert_is_one_equi_join(spark):
    rows = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    text = plan(joins.upsert_rows(rows, rows.where("k > 5"), ["k"]))
    assert "FullOuter" in text and "NestedLoop" not in text
