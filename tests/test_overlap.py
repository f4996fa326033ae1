"""Overlap suppression against a direct greedy pass."""

import math
import random

import pytest

from roadpulse.operators.overlap import suppress_overlaps

SCHEMA = (
    "box_id bigint, source_id string, frame int, class_id int, confidence double, "
    "x1 double, y1 double, x2 double, y2 double"
)
NAN, INF = float("nan"), float("inf")


def solid(box):
    corners = box[5:]
    return all(c is not None and math.isfinite(c) for c in corners) and corners[2] > corners[0] and corners[3] > corners[1]


def iou(a, b):
    if not (solid(a) and solid(b)):
        return 0.0
    w = max(min(a[7], b[7]) - max(a[5], b[5]), 0.0)
    h = max(min(a[8], b[8]) - max(a[6], b[6]), 0.0)
    return w * h / ((a[7] - a[5]) * (a[8] - a[6]) + (b[7] - b[5]) * (b[8] - b[6]) - w * h)


def greedy(rows, by_class, threshold):
    def place(r):
        unknown = r[4] is None or math.isnan(r[4])
        return (INF if unknown else -r[4], r[0])

    def group(r):
        return (r[1], r[2], r[3]) if by_class else (r[1], r[2])

    kept = []
    for row in sorted(rows, key=place):
        if all(group(k) != group(row) or iou(k, row) <= threshold for k in kept):
            kept.append(row)
    return sorted(r[0] for r in kept)


def boxes(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # Frame 0 is crowded; sizes span a wide range; some boxes are copies, or have no area or odd numbers.
        frame = 0 if rng.random() < 0.7 else rng.choice([1, 2, None])
        if rows and rng.random() < 0.2:
            corners = list(rng.choice(rows)[5:])
        else:
            x1, y1 = rng.uniform(-50, 150), rng.uniform(-50, 150)
            w = rng.choice([0.0, 3.0, 20.0, 60.0, 65.0, 70.0, 300.0]) * rng.uniform(0.9, 1.1)
            corners = [x1, y1, x1 + w, y1 + w * rng.uniform(0.8, 1.2)]
        if rng.random() < 0.1:
            corners[rng.randrange(4)] = rng.choice([None, NAN, INF, -INF])
        confidence = rng.choice([None, NAN, INF, 0.0, -0.0]) if rng.random() < 0.15 else rng.randrange(30) / 30
        source, kind = rng.choice(["cam_01", "cam_02", None]), rng.choice([2, 3, None])
        rows.append((i, source, frame, kind, confidence, *corners))
    return rows


def ids(spark, rows, *args):
    return sorted(r.box_id for r in suppress_overlaps(spark.createDataFrame(rows, SCHEMA), *args).collect())


@pytest.mark.parametrize("threshold", [0.0, 0.5, 0.7, 1.0])
@pytest.mark.parametrize("class_col", ["class_id", None])
def test_equals_greedy(spark, threshold, class_col):
    for seed in range(1):
        rows = boxes(seed, 150)
        assert ids(spark, rows, threshold, class_col) == greedy(rows, class_col is not None, threshold)


def test_a_chain_of_boxes(spark):
    """Each box overlaps the next; every other one goes."""
    rows = [(i, "cam_01", 1, 2, 1 - i / 500, i * 10.0, 0.0, i * 10.0 + 100, 50.0) for i in range(200)]
    assert ids(spark, rows, 0.7) == greedy(rows, True, 0.7)


def test_cameras_do_not_suppress_each_other(spark):
    rows = [(i, f"cam_0{i}", 1, 2, 0.9, 0.0, 0.0, 10.0, 10.0) for i in range(4)]
    assert ids(spark, rows) == [0, 1, 2, 3]


def test_a_frame_with_many_boxes(spark):
    rows = [(i, "cam_01", 1, 2, (i * 37 % 101) / 101, i % 60 * 30.0, i // 60 * 30.0, i % 60 * 30.0 + 28, i // 60 * 30.0 + 28) for i in range(3000)]
    rows += [(5000 + i, *r[1:4], r[4] / 2, r[5] + 1, *r[6:]) for i, r in enumerate(rows)]
    assert ids(spark, rows) == list(range(3000))


def test_bad_thresholds(spark):
    for bad in (-0.1, 1.1, NAN):
        with pytest.raises(ValueError):
            suppress_overlaps(spark.createDataFrame([], SCHEMA), bad)


def test_a_long_chain_in_an_unknown_frame(spark):
    """10,000 boxes, each better than the next and overlapping it; strips of 700 boxes take several rounds."""
    rows = [(i, "cam_01", None, 2, 1 - i / 20_000, i * 10.0, 0.0, i * 10.0 + 100, 50.0) for i in range(10_000)]
    rows += [(20_000 + i, "cam_02", i, 2, 0.5, 0.0, 0.0, 10.0, 10.0) for i in range(500)]
    kept = suppress_overlaps(spark.createDataFrame(rows, SCHEMA), 0.7, block_boxes=700)
    assert sorted(r.box_id for r in kept.collect()) == [*range(0, 10_000, 2), *range(20_000, 20_500)]


def test_strips_give_what_whole_groups_give(spark):
    rows = [(r[0], "cam_01", 0, 2, *r[4:]) for r in boxes(11, 300)]
    for threshold in (0.0, 0.4):
        got = suppress_overlaps(spark.createDataFrame(rows, SCHEMA), threshold, block_boxes=25)
        assert sorted(r.box_id for r in got.collect()) == greedy(rows, True, threshold)


def test_many_copies_of_a_box_are_one(spark):
    rows = [(i, "cam_01", 1, 2, (i * 7919 % 5_000) / 5_000, 0.0, 0.0, 10.0, 10.0) for i in range(5_000)]
    best = max(rows, key=lambda r: (r[4], -r[0]))
    assert ids(spark, rows) == [best[0]]
