"""Filters, scalars and projections on literal rows, at their boundaries."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import camera_table, config_violations
from roadpulse.functions import clock, traffic
from roadpulse.operators import filters, projections
from roadpulse.schema import EVENT_SCHEMA

EVENT = "source_id string, tracker_id int, vehicle_type string, speed_kmh double, confidence double, timestamp string"


def events(spark, *changes):
    base = dict(
        source_id="cam_01",
        tracker_id=1,
        vehicle_type="car",
        speed_kmh=50.0,
        confidence=0.9,
        timestamp="2024-01-01 00:00:00",
    )
    return spark.createDataFrame([{**base, **c} for c in changes], EVENT)


def speeds(df):
    return sorted(r.speed_kmh for r in df.collect())


def test_live_filter_boundaries(spark):
    nan = float("nan")
    df = events(
        spark,
        {"speed_kmh": 0.0},
        {"speed_kmh": -0.1},
        {"speed_kmh": 149.99},
        {"speed_kmh": 150.0},
        {"speed_kmh": nan},
        {"speed_kmh": None},
        {"speed_kmh": 1.0, "confidence": 0.3},
        {"speed_kmh": 2.0, "confidence": 0.301},
        {"speed_kmh": 3.0, "confidence": None},
        {"speed_kmh": 4.0, "source_id": None},
        {"speed_kmh": 5.0, "tracker_id": None},
        {"speed_kmh": 6.0, "vehicle_type": None},
        {"speed_kmh": 7.0, "timestamp": None},
    )
    assert speeds(filters.valid_live(df)) == [0.0, 2.0, 7.0, 149.99]


def test_batch_filter_drops_standing_and_ignores_confidence(spark):
    df = events(
        spark,
        {"speed_kmh": 0.0},
        {"speed_kmh": 0.01},
        {"speed_kmh": 149.99},
        {"speed_kmh": 150.0},
        {"speed_kmh": float("nan")},
        {"speed_kmh": 1.0, "confidence": None},
        {"speed_kmh": 2.0, "confidence": 0.0},
        {"speed_kmh": 3.0, "timestamp": None},
    )
    assert speeds(filters.valid_batch(df)) == [0.01, 1.0, 2.0, 149.99]


def test_unparsable_times_are_dropped_without_error(spark):
    df = events(
        spark,
        {"timestamp": "2024-02-29 23:59:59"},
        {"timestamp": "2023-02-29 00:00:00"},
        {"timestamp": "not-a-time"},
        {"timestamp": None},
    )
    kept = filters.parsable_time(df).collect()
    assert [r.event_time for r in kept] == [datetime(2024, 2, 29, 23, 59, 59)]


@pytest.mark.parametrize(
    "speed, count, status",
    [
        (None, 5, "SEPI"),
        (20.0, None, "SEPI"),
        (20.0, 0, "SEPI"),
        (1.0, 2, "LANCAR"),
        (9.99, 3, "MACET"),
        (10.0, 3, "PADAT"),
        (29.99, 3, "PADAT"),
        (30.0, 3, "LANCAR"),
    ],
)
def test_status_rules_in_order(spark, speed, count, status):
    row = spark.createDataFrame([(speed, count)], "s double, n bigint")
    assert row.select(traffic.traffic_status(F.col("s"), F.col("n"))).first()[0] == status


def test_rounding_goes_up_on_ties(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (0.125,)], "x double")
    got = [r[0] for r in df.select(traffic.rounded(F.col("x"), 2)).collect()]
    assert got == [2.68, 1.01, 0.13]


def test_names_and_labels(spark):
    ids = spark.createDataFrame([(2,), (7,), (0,), (None,)], "c int")
    names = [r[0] for r in ids.select(traffic.class_name(F.col("c"))).collect()]
    assert names == ["car", "truck", "unknown", "unknown"]
    cams = spark.createDataFrame([("cam_01",), ("cam_02",), ("cam_09",)], "s string")
    labels = cams.select(traffic.camera_label(F.col("s")), traffic.camera_place(F.col("s")))
    assert [tuple(r) for r in labels.collect()] == [
        ("Kamera 1", "Simpang Ciawi"),
        ("Kamera 2", C.DEFAULT_PLACE),
        ("cam_09", C.DEFAULT_PLACE),
    ]


def test_load_score_is_clamped_and_rounds_half_up(spark):
    df = spark.createDataFrame([(80.0, 4), (0.0, 0), (20.0, 5), (0.0, 50)], "s double, n int")
    got = [r[0] for r in df.select(traffic.load_score(F.col("s"), F.col("n"))).collect()]
    assert got == [25, 100, 63, 100]


def test_speed_expressions(spark):
    df = spark.createDataFrame([(0.0,), (40.0,), (80.0,), (299.9,), (300.0,)], "s double")
    rows = df.select(traffic.plausible_speed(F.col("s")), traffic.speed_norm(F.col("s"))).collect()
    assert [r[0] for r in rows] == [None, 40.0, 80.0, 299.9, None]
    assert [r[1] for r in rows] == [0.0, 0.5, 1.0, 1.0, 1.0]


def test_alert_texts(spark):
    df = spark.createDataFrame(
        [("cam_01", "MACET", datetime(2024, 1, 1, 7, 5)), ("cam_02", "PADAT", None)],
        "s string, t string, u timestamp_ntz",
    )
    rows = df.select(
        traffic.alert_title(F.col("s"), F.col("t")),
        traffic.alert_severity(F.col("t")),
        traffic.alert_time(F.col("u")),
    )
    assert [tuple(r) for r in rows.collect()] == [
        ("cam_01 macet", "Tinggi", "07:05"),
        ("cam_02 padat", "Sedang", "baru saja"),
    ]


def test_local_day_bounds_follow_the_zone():
    start, end = clock.local_day_bounds(datetime(2024, 1, 14, 17, 30, tzinfo=timezone.utc))
    assert (start, end) == (datetime(2024, 1, 15), datetime(2024, 1, 16))
    assert clock.local_day_bounds(datetime(2024, 1, 15, 23, 59)) == (start, end)


def test_day_and_recent_filters_are_half_open(spark):
    noon = datetime(2024, 1, 15, 12)
    rows = [(datetime(2024, 1, 15),), (datetime(2024, 1, 16),), (noon - timedelta(hours=1),)]
    df = spark.createDataFrame(rows, "window_end timestamp_ntz")
    assert filters.local_day(df, noon).count() == 2
    assert filters.recent(df, noon, column="window_end").count() == 2


def test_iso_time_is_utc(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 15, 3, 4, 5, 678000),)], "t timestamp_ntz")
    assert df.select(clock.iso_utc(F.col("t"))).first()[0] == "2024-01-14T20:04:05.678Z"


def test_live_row_survives_values_too_wide_for_the_table(spark):
    df = spark.createDataFrame(
        [("cam_01", datetime(2024, 1, 1), datetime(2024, 1, 1), 3, 12345.678, 99.995, 1.0, 0.5, "X")],
        "source_id string, window_start timestamp_ntz, window_end timestamp_ntz, total_count bigint,"
        "avg_speed double, max_speed double, min_speed double, avg_confidence double,"
        "traffic_status string",
    )
    row = projections.live_row(df, clock.ntz(datetime(2024, 1, 1))).first()
    assert row.avg_speed is None and str(row.max_speed) == "100.00"


def test_snapshot_defaults(spark):
    df = spark.createDataFrame(
        [("cam_01", None, None, None, None, None), ("cam_02", 3, 1.5, 2.5, "", None)],
        "source_id string, total_count int, avg_speed double, max_speed double,"
        "traffic_status string, updated_at timestamp_ntz",
    )
    rows = [tuple(r) for r in projections.snapshot_view(df).collect()]
    assert rows == [
        ("cam_01", 0, 0.0, 0.0, "LANCAR", None),
        ("cam_02", 3, 1.5, 2.5, "LANCAR", None),
    ]


def test_camera_settings_are_checked(spark):
    good = {"source_id": "a", "roi": [(0, 0), (9, 0), (9, 9), (0, 9)], "target_w": 1.0, "target_h": 1.0}
    cameras = camera_table(
        spark,
        [
            good,
            {**good, "source_id": "b", "roi": good["roi"][:3]},
            {**good, "source_id": "c", "roi": [(0, 0), (1920, 0), (9, 9), (0, 9)]},
            {**good, "source_id": "d", "target_w": 0.0},
        ],
    ).withColumn("video_source", F.when(F.col("source_id") == "a", "RTSP://x").otherwise("a/b.mp4"))
    found = {tuple(r) for r in config_violations(cameras).collect()}
    assert found == {("b", "roi_points"), ("c", "roi_outside_frame"), ("d", "target_size")}


def test_event_schema_is_nullable():
    assert all(f.nullable for f in EVENT_SCHEMA.fields)


def test_timeline_of_odd_rows(spark):
    """A row without a type is left out; of repeated rows the one with the most vehicles counts."""
    from roadpulse.operators import serving

    at = [datetime(2024, 1, 1, h) for h in (1, 2)]
    rows = [("a", at[0], "car", 2, 10.0), ("a", at[0], "car", 5, 20.0), ("a", at[0], None, 9, 9.0), ("a", at[1], "bus", None, None)]
    df = spark.createDataFrame(rows, "source_id string, window_end timestamp_ntz, vehicle_type string, vehicle_count int, avg_speed_kmh double")
    got = {(r.recorded_at.hour, r.vehicle_type, r.metric): r.value for r in serving.type_timeline(df).collect()}
    assert got[(1, "car", "count")] == 5 and got[(1, "car", "speed")] == 20.0
    assert got[(2, "car", "count")] == got[(2, "bus", "count")] == got[(1, "bus", "speed")] == 0.0
    assert len(got) == 8


def test_times_with_offsets(spark):
    texts = ["2024-01-01T10:00:00+07:00", "2024-01-01T03:00:00Z", "2024-01-01 10:00:00", "2024-01-01T00:30:00.5-02:30", "2024-01-01", None]
    df = spark.createDataFrame([(t,) for t in texts], "timestamp string")
    kept = [r.event_time for r in filters.parsable_time(df).collect()]
    assert kept == [datetime(2024, 1, 1, 10)] * 3 + [datetime(2024, 1, 1, 10, 0, 0, 500_000)]
    assert tuple(filters.unparsable_times(df).first()) == (4, 1, 1)
