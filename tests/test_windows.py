"""Trajectory operators against a direct simulation, whole and cut into slices."""

import math
import random
from collections import deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import windows

FPS = 7.0


@pytest.fixture(scope="module")
def walk(spark):
    rng = random.Random(5)
    rows, event = [], 0
    # One track holds most rows; others are short; frames have gaps of very different size.
    for tracker, n in [(1, 700), (2, 40), (3, 2), (4, 1), (5, 0), (6, 90)]:
        frame, x, y = rng.randrange(50), 0.0, 0.0
        for _ in range(n):
            frame += rng.choice([1, 1, 1, 2, 300])
            x, y = x + rng.uniform(-1, 3), y + rng.uniform(-1, 1)
            rows.append((event, "cam_01", tracker, frame, x, y, rng.choice([2, 3, 5])))
            event += 1
    # Rows of an unknown camera form a track of their own.
    rows += [(event + i, None, 1, i, float(i), 0.0, 2) for i in range(5)]
    rng.shuffle(rows)
    schema = "event_id int, source_id string, tracker_id int, frame int, mx double, my double, class_id int"
    df = spark.createDataFrame(rows, schema).repartition(4).cache()
    return rows, df


def simulate(rows, fps=FPS):
    """One pass per track with bounded queues."""
    out, tracks = {}, {}
    for event, source, tracker, frame, x, y, _ in sorted(rows, key=lambda r: r[3]):
        recent, path, speeds = tracks.setdefault(
            (source, tracker), (deque(maxlen=int(fps)), deque(maxlen=30), deque(maxlen=10))
        )
        recent.append((x, y))
        path.append((x, y))
        end = math.dist(recent[0], recent[-1]) / (len(recent) / fps) * 3.6
        raw = smooth = None
        if len(path) >= 3:
            points = list(path)
            raw = sum(math.dist(a, b) for a, b in zip(points, points[1:])) / (len(points) / fps) * 3.6
            speeds.append(raw)
            smooth = sum(speeds) / len(speeds) if len(speeds) >= 3 else raw
        out[event] = (len(recent), end, raw, smooth, list(path))
    return out


# Tiny slices put cuts everywhere, even with fewer rows per slice than the look-back.
@pytest.mark.parametrize("slice_rows", [10**6, 100, 37, 5])
def test_speeds_equal_simulation(walk, slice_rows):
    rows, df = walk
    want = simulate(rows)
    end = windows.endpoint_speed(df, FPS, slice_rows=slice_rows).collect()
    assert len(end) == len(rows)
    for r in end:
        assert (r.points, r.speed_kmh) == pytest.approx(want[r.event_id][:2], abs=1e-9)
    smooth = windows.smooth_speed(df, FPS, slice_rows=slice_rows).collect()
    assert len(smooth) == len(rows)
    for r in smooth:
        assert r.path_speed_kmh == pytest.approx(want[r.event_id][2], abs=1e-9)
        assert r.smooth_speed_kmh == pytest.approx(want[r.event_id][3], abs=1e-9)


@pytest.mark.parametrize("slice_rows", [10**6, 50])
def test_trajectories_equal_simulation(walk, slice_rows):
    rows, df = walk
    want = simulate(rows)
    got = windows.trajectory_array(df, slice_rows=slice_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(p.x, p.y) for p in r.trajectory] == want[r.event_id][4]


def test_short_frame_rate_keeps_one_point(walk):
    _, df = walk
    got = windows.endpoint_speed(df, 0.5, slice_rows=50).collect()
    assert {(r.points, r.speed_kmh) for r in got} == {(1, 0.0)}


def test_first_and_last_class(walk):
    rows, df = walk
    known = [r for r in rows if r[1]]
    first = {r.tracker_id: r.class_id for r in windows.first_class(df.where("source_id is not null")).collect()}
    last = {r.tracker_id: r for r in windows.last_seen(df.where("source_id is not null")).collect()}
    for tracker in first:
        track = sorted((r for r in known if r[2] == tracker), key=lambda r: r[3])
        assert first[tracker] == track[0][6]
        assert (last[tracker].class_id, last[tracker].mx) == (track[-1][6], track[-1][4])
    carried = windows.with_first_class(df.where("source_id is not null")).collect()
    assert len(carried) == len(known)
    assert all(r.class_id == first[r.tracker_id] for r in carried)


def test_box_smoothing_equals_unsliced(walk):
    _, df = walk
    boxes = df.select(
        "event_id", "source_id", "tracker_id", "frame", F.col("mx").alias("x1"), F.col("my").alias("y1"),
        (F.col("mx") + 2).alias("x2"), (F.col("my") + 3).alias("y2"),
    )
    whole = {r.event_id: r for r in windows.smooth_boxes(boxes).collect()}
    cut = windows.smooth_boxes(boxes, slice_rows=20).collect()
    assert len(cut) == len(whole)
    for r in cut:
        assert tuple(r) == pytest.approx(tuple(whole[r.event_id]))


def test_heat_points_keep_plausible_last_rows(spark):
    rows = [
        ("a", 1, 1, 0.0, 0.0, 500.0), ("a", 1, 2, 1.0, 1.0, 40.0),
        ("a", 2, 1, 0.0, 0.0, 40.0), ("a", 2, 2, 2.0, 2.0, 300.0), ("a", 3, 1, 3.0, 3.0, 200.0),
    ]
    df = spark.createDataFrame(rows, "source_id string, tracker_id int, frame int, mx double, my double, speed_kmh double")
    got = {r.tracker_id: (r.mx, r.heat) for r in windows.heat_points(df).collect()}
    assert got == {1: (1.0, 0.5), 3: (3.0, 1.0)}


def visits(rows, seconds):
    """Number of the visit of each row: a track unseen for longer starts anew."""
    out, last = {}, {}
    for event, source, tracker, frame, *_ in sorted(rows, key=lambda r: r[3]):
        before = last.get((source, tracker))
        number = 0 if before is None else before[1] + (frame - before[0] > seconds)
        last[(source, tracker)] = (frame, number)
        out[event] = number
    return out


@pytest.mark.parametrize("slice_rows", [10**6, 37])
def test_a_track_unseen_for_long_starts_anew(walk, slice_rows):
    """A frame stands for a second here; jumps of 300 frames part visits."""
    rows, df = walk
    number = visits(rows, 5)
    apart = [(e, s, (t, number[e]), f, x, y, c) for e, s, t, f, x, y, c in rows]
    want = simulate(apart)
    timed = df.withColumn("ts", F.timestamp_seconds("frame"))
    end = windows.endpoint_speed(timed, FPS, gap="5 seconds", slice_rows=slice_rows).collect()
    for r in end:
        assert (r.points, r.speed_kmh) == pytest.approx(want[r.event_id][:2], abs=1e-9)
    for r in windows.smooth_speed(timed, FPS, gap="5 seconds", slice_rows=slice_rows).collect():
        assert r.path_speed_kmh == pytest.approx(want[r.event_id][2], abs=1e-9)
        assert r.smooth_speed_kmh == pytest.approx(want[r.event_id][3], abs=1e-9)
    for r in windows.trajectory_array(timed, gap="5 seconds", slice_rows=slice_rows).collect():
        assert [(p.x, p.y) for p in r.trajectory] == want[r.event_id][4]
    assert len(end) == len(rows)


@pytest.mark.parametrize("slice_rows", [10**6, 50])
def test_each_track_has_its_own_frame_rate(walk, slice_rows):
    rows, df = walk
    rate = {1: 7.0, 2: 12.5, 6: 3.0}
    column = F.when(F.col("tracker_id") == 1, 7.0).when(F.col("tracker_id") == 2, 12.5).when(F.col("tracker_id") == 6, 3.0)
    got = windows.endpoint_speed(df.withColumn("fps", column), "fps", rates=[7.0, 12.5, 3.0], slice_rows=slice_rows).collect()
    want = {fps: simulate(rows, fps) for fps in (7.0, 12.5, 3.0, 25.0)}
    for r in got:
        assert (r.points, r.speed_kmh) == pytest.approx(want[rate.get(r.tracker_id, 25.0)][r.event_id][:2], abs=1e-9)
    assert len(got) == len(rows)


@pytest.mark.parametrize("slice_rows", [10**6, 50])
def test_first_class_in_the_same_pass(walk, slice_rows):
    rows, df = walk
    first = {}
    for r in sorted(rows, key=lambda r: r[3]):
        first.setdefault((r[1], r[2]), r[6])
    got = windows.endpoint_speed(df, FPS, first="class_id", slice_rows=slice_rows).collect()
    assert len(got) == len(rows)
    assert all(r.class_id == first[(r.source_id, r.tracker_id)] for r in got)


def test_speeds_recover_from_an_outlier_and_a_nan(spark):
    rows = [("a", 1, f, f * 0.1, 0.0) for f in range(200)]
    rows[60] = ("a", 1, 60, 1e15, 0.0)
    rows[120] = ("a", 1, 120, float("nan"), 0.0)
    df = spark.createDataFrame(rows, "source_id string, tracker_id int, frame int, mx double, my double")
    got = {r.frame: r for r in windows.smooth_speed(df, 25.0).collect()}
    steady = got[50].path_speed_kmh
    for frame in (105, 110, 165, 199):
        assert got[frame].path_speed_kmh == pytest.approx(steady)
        assert got[frame].smooth_speed_kmh == pytest.approx(steady)


def test_first_value_of_a_visit_does_not_depend_on_slices(spark):
    """Sliced equals whole equals a simulation, for tracks that come back after a gap."""
    rng = random.Random(4)
    begin, rows = datetime(2024, 1, 1), []
    for source, tracker, n in [("a", 1, 300), (None, 2, 60), ("b", None, 7), ("b", 3, 1)]:
        at, frame = begin, 0
        for _ in range(n):
            at += timedelta(minutes=rng.choice([1, 1, 1, 5, 59, 60, 61, 300]) if rng.random() < 0.3 else 1)
            frame += rng.choice([1, 2, 50])
            rows.append((source, tracker, frame, at, float(frame), 1.0, rng.choice([2, 3, 5, None])))
    schema = "source_id string, tracker_id int, frame int, ts timestamp_ntz, mx double, my double, class_id int"
    df = spark.createDataFrame(rng.sample(rows, len(rows)), schema)
    want, last, first = {}, {}, {}
    for source, tracker, frame, at, *_, kind in rows:
        key = (source, tracker)
        if key not in last or at - last[key] > timedelta(hours=1):
            first[key] = kind
        last[key] = at
        want[(*key, frame)] = first[key]
    plain = {(r.source_id, r.tracker_id, r.frame): (r.points, r.speed_kmh) for r in windows.endpoint_speed(df, FPS, gap="1 hour").collect()}
    for slice_rows in (10**6, 20):
        got = windows.endpoint_speed(df, FPS, first="class_id", gap="1 hour", slice_rows=slice_rows)
        assert got.columns == [*df.columns, "points", "speed_kmh"]
        found = {(r.source_id, r.tracker_id, r.frame): r for r in got.collect()}
        assert {k: r.class_id for k, r in found.items()} == want
        assert {k: (r.points, r.speed_kmh) for k, r in found.items()} == plain


def test_a_long_track_keeps_its_first_class_per_visit(spark):
    """200 rows of one visit, seen first as class 2."""
    begin = datetime(2024, 1, 1)
    rows = [("a", 1, f, begin + timedelta(seconds=f), float(f), 0.0, 2 if f == 0 else 3) for f in range(200)]
    schema = "source_id string, tracker_id int, frame int, ts timestamp_ntz, mx double, my double, class_id int"
    got = windows.endpoint_speed(spark.createDataFrame(rows, schema), FPS, first="class_id", gap="1 hour", slice_rows=20)
    assert [r.class_id for r in got.collect()] == [2] * 200
