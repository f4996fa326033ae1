"""Aggregates on literal rows."""

from collections import Counter, defaultdict
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators import aggregates, joins, serving
from roadpulse.schema import HOURLY_SUMMARY_SCHEMA, contract_violations, schema_violations
from workload import groups

EVENT = (
    "event_time timestamp_ntz, source_id string, tracker_id int, vehicle_type string, "
    "speed_kmh double, confidence double, timestamp string"
)


def at(minute, second=0):
    return datetime(2024, 1, 1, 10 + minute // 60, minute % 60, second)


def events(spark, rows):
    full = [(t, s, n, v, k, 0.9, str(t)) for t, s, n, v, k in rows]
    return spark.createDataFrame(full, EVENT)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 179),
            st.sampled_from(["a", "b"]),
            st.integers(1, 3),
            st.sampled_from(["bus", "car", "truck"]),
            st.integers(1, 149),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_vehicle_and_type_summaries_equal_simulation(spark, rows):
    df = events(spark, [(at(m), s, n, v, float(k)) for m, s, n, v, k in rows])
    groups = defaultdict(list)
    for m, s, n, v, k in rows:
        groups[(10 + m // 60, s, n)].append((v, k))
    want = {}
    for key, seen in groups.items():
        counts = Counter(v for v, _ in seen)
        top = max(counts.values())
        kind = min(v for v, c in counts.items() if c == top)
        speeds = [k for _, k in seen]
        want[key] = (kind, sum(speeds) / len(speeds), len(speeds), min(speeds), max(speeds))
    level = aggregates.vehicle_level(df)
    got = {(r.window_start.hour, r.source_id, r.tracker_id): tuple(r)[3:] for r in level.collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key][0] == want[key][0]
        assert got[key][1:] == pytest.approx(want[key][1:])
    totals = {
        (r.window_start.hour, r.source_id): (r.total_vehicles, r.avg_speed_kmh)
        for r in aggregates.total_summary(aggregates.vehicle_means(df)).collect()
    }
    for (hour, source), (n, mean) in totals.items():
        means = [v[1] for k, v in want.items() if k[:2] == (hour, source)]
        assert n == len(means)
        assert mean == pytest.approx(sum(means) / n, abs=0.0051)
    assert sum(r.vehicle_count for r in aggregates.type_summary(level).collect()) == len(want)


def test_live_window_edges_and_status(spark):
    rows = [(at(0, s), "a", n, "car", 5.0) for s, n in [(0, 1), (4, 2), (4, 3), (5, 4)]]
    for exact in (True, False):
        got = aggregates.live_windows(events(spark, rows), exact=exact).orderBy("window_start").collect()
        assert [(r.window_start.second, r.total_count, r.traffic_status) for r in got] == [
            (0, 3, "MACET"),
            (5, 1, "LANCAR"),
        ]


def test_approximate_count_stays_near_exact(spark):
    df = spark.range(20_000).select(
        F.lit(at(0)).cast("timestamp_ntz").alias("event_time"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("source_id"),
        (F.col("id") % 700).cast("int").alias("tracker_id"),
        F.lit(1.0).alias("speed_kmh"),
        F.lit(0.9).alias("confidence"),
    )
    for row in aggregates.live_windows(df).collect():
        assert row.total_count == pytest.approx(100, rel=0.15)


def test_rollup_modes(spark):
    rows = [(at(0), "a", n, "car", 5.0) for n in (1, 2, 3)] + [(at(1), "a", 1, "car", 80.0)]
    live = aggregates.live_windows(events(spark, rows), exact=True)
    latest = aggregates.latest_per_source(live).first()
    assert (latest.window_start, latest.total_count, latest.avg_speed) == (at(1), 1, 80.0)
    parts = aggregates.latest_per_source(live, "componentwise").first()
    assert (parts.total_count, parts.avg_speed, parts.min_speed) == (3, 80.0, 5.0)
    assert parts.traffic_status == "LANCAR"
    with pytest.raises(ValueError):
        aggregates.latest_per_source(live, "other")


def test_window_range_counts_each_filter(spark):
    df = events(
        spark,
        [
            (at(0), "a", 1, "car", 10.0),
            (at(61), "a", 1, "car", 0.0),
            (at(62), "a", 2, "car", None),
            (at(63), None, 3, "car", 10.0),
            (None, "a", 4, "car", 10.0),
        ],
    )
    row = aggregates.window_range(df).first()
    assert (row.rows_read, row.rows_complete, row.rows_kept, row.unique_vehicles) == (5, 3, 1, 1)
    assert row.first_window == row.last_window == at(0)


def test_quality_report_of_the_last_hour(spark):
    rows = [(at(0), "a", -1.0), (at(0), "a", 50.0), (at(0), "b", 201.0), (at(0), "c", 200.0)]
    old = [(datetime(2023, 1, 1), "d", 500.0)] * 2
    df = spark.createDataFrame(rows + old, "window_start timestamp_ntz, source_id string, avg_speed_kmh double")
    duplicates, anomalies = aggregates.quality_report(df, at(30))
    assert [(r.source_id, r.dup_count) for r in duplicates.collect()] == [("a", 2)]
    assert {r.source_id: r.is_anomaly for r in anomalies.collect()} == {"a": True, "b": True, "c": False}


def test_empty_network(spark):
    empty = spark.createDataFrame(
        [], "source_id string, total_vehicles int, avg_speed double, max_speed double,"
        "traffic_status string, last_update timestamp_ntz",
    )
    assert tuple(aggregates.network_summary(empty).first()) == (0, 0.0, 0)
    roster = spark.createDataFrame([("cam_01",), ("cam_02",)], "source_id string")
    for whole in (False, True):
        got = joins.roster_default(empty, roster, whole).collect()
        assert {(r.source_id, r.total_vehicles, r.traffic_status) for r in got} == {
            ("cam_01", 0, "MENUNGGU"),
            ("cam_02", 0, "MENUNGGU"),
        }
    alerts = serving.top_alerts(spark, empty).collect()
    assert [tuple(r) for r in alerts] == [("Belum ada data realtime", "Menunggu sinkronisasi", "Info")]
    cards = [tuple(r) for r in serving.route_cards(empty).collect()]
    assert cards == [("Camera-01", 72, "PADAT"), ("Camera-02", 58, "LANCAR")]


def test_roster_with_some_snapshots(spark):
    one = spark.createDataFrame(
        [("cam_02", 5, 1.0, 2.0, "MACET", at(0))],
        "source_id string, total_vehicles int, avg_speed double, max_speed double,"
        "traffic_status string, last_update timestamp_ntz",
    )
    roster = spark.createDataFrame([("cam_01",), ("cam_02",)], "source_id string")
    each = {r.source_id: r.traffic_status for r in joins.roster_default(one, roster).collect()}
    assert each == {"cam_01": "MENUNGGU", "cam_02": "MACET"}
    assert [r.source_id for r in joins.roster_default(one, roster, True).collect()] == ["cam_02"]
    alerts = serving.top_alerts(spark, one).collect()
    assert [(r.title, r.severity) for r in alerts] == [("cam_02 macet", "Tinggi")]
    assert [r.name for r in serving.route_cards(one).collect()] == ["cam_02"]
    free = one.withColumn("traffic_status", F.lit("LANCAR"))
    assert serving.top_alerts(spark, free).collect() == []


def test_timeline_is_dense_per_camera(spark):
    rows = [(at(0), "a", "car", 2, 10.0), (at(60), "a", "bus", 1, None), (at(60), "b", "truck", 4, 5.0)]
    df = spark.createDataFrame(
        rows, "window_end timestamp_ntz, source_id string, vehicle_type string, vehicle_count int, avg_speed_kmh double"
    )
    got = {
        (r.source_id, r.recorded_at.hour, r.vehicle_type, r.metric): r.value
        for r in serving.type_timeline(df).collect()
    }
    assert len(got) == 10
    assert got[("a", 10, "bus", "count")] == 0.0 and got[("a", 10, "car", "speed")] == 10.0
    assert got[("a", 11, "bus", "count")] == 1.0 and got[("a", 11, "bus", "speed")] == 0.0
    wide = serving.pivot_types(df, "a", ["car", "bus", "truck"]).collect()
    assert [(r.car_count, r.bus_count, r.truck_count, r.car_speed) for r in wide] == [(2, 0, 0, 10.0), (0, 1, 0, 0.0)]


def test_tail_and_latest(spark):
    rows = [(at(m), "a", "car" if m % 2 else "bus", m) for m in range(30)]
    df = spark.createDataFrame(rows, "window_end timestamp_ntz, source_id string, vehicle_type string, vehicle_count int")
    history = aggregates.camera_history(df)
    tail = serving.tail_intervals(history).collect()
    assert [r.recorded_at for r in tail] == [at(m) for m in range(6, 30)]
    latest = serving.latest_by_type(df.withColumn("avg_speed_kmh", F.lit(1.0))).collect()
    assert [(r.vehicle_type, r.vehicle_count) for r in latest] == [("car", 29), ("bus", 28)]


def test_contracts(spark):
    df = spark.createDataFrame(
        [("cam_01", 1), ("cam_01", 1), (None, 1), ("a-very-long-camera-name", 2)],
        "source_id string, n int",
    )
    got = {
        (r.check, r.column_name): r.violations
        for r in contract_violations(df, ["source_id"], {"source_id": 20}, ["source_id", "n"]).collect()
    }
    assert got == {("not_null", "source_id"): 1, ("max_length", "source_id"): 1, ("unique", "source_id,n"): 1}
    problems = schema_violations(df, HOURLY_SUMMARY_SCHEMA)
    assert ("total_vehicles", "missing", "int") in problems
    assert not [p for p in problems if p[0] == "source_id"]


def test_quality_report_reads_the_events_once(spark, small):
    report = groups.dq_quality_report(spark, small)
    files = report.inputFiles()
    assert files and not any("events.parquet" in f for f in files)
