"""Projection, polygons and boxes against independent arithmetic."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import TO_METRES, TO_PIXELS, camera_table, corners, matrix, with_corners, with_projection
from roadpulse.functions import geometry as G

ALL = [*C.CAMERAS, {**C.CALIBRATION_CAMERAS[0], "source_id": "cam_03"}]


def solve(source, target):
    rows, right = [], []
    for (x, y), (u, v) in zip(source, target):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    h = np.linalg.solve(np.array(rows, float), np.array(right, float))
    return np.append(h, 1.0).reshape(3, 3)


@pytest.mark.parametrize("minus_one", [True, False])
def test_projection_equals_linear_solve_and_returns(spark, minus_one):
    points = [(900.0, 300.0), (1000.0, 450.0), (850.0, 270.0), (500.0, 400.0)]
    grid = spark.createDataFrame(points, "px double, py double")
    cameras = with_projection(camera_table(spark, ALL), minus_one)
    mx, my = G.project(matrix(TO_METRES), F.col("px"), F.col("py"))
    ix, iy = G.project(matrix(TO_PIXELS), F.col("mx"), F.col("my"))
    rows = (
        cameras.crossJoin(grid).withColumns({"mx": mx, "my": my}).withColumns({"ix": ix, "iy": iy})
    ).collect()
    assert len(rows) == 12
    settings = {c["source_id"]: c for c in ALL}
    for row in rows:
        camera = settings[row.source_id]
        w, h = camera["target_w"] - minus_one, camera["target_h"] - minus_one
        m = solve(camera["roi"], [(0, 0), (w, 0), (w, h), (0, h)])
        u, v, depth = m @ [row.px, row.py, 1.0]
        assert (row.mx, row.my) == pytest.approx((u / depth, v / depth), abs=1e-6)
        assert (row.ix, row.iy) == pytest.approx((row.px, row.py), abs=1e-6)


def test_polygon_with_horizontal_edges(spark):
    square = {"source_id": "s", "roi": [(0, 0), (10, 0), (10, 10), (0, 10)], "target_w": 2, "target_h": 2}
    points = [(5.0, 5.0), (-1.0, 5.0), (11.0, 5.0), (5.0, -0.1), (5.0, 10.1), (9.9, 0.1)]
    grid = spark.createDataFrame(points, "px double, py double")
    inside = G.inside_quad(corners(), F.col("px"), F.col("py"))
    rows = with_corners(camera_table(spark, [square])).crossJoin(grid).select("px", "py", inside.alias("i")).collect()
    assert {(r.px, r.py): r.i for r in rows} == dict(zip(points, [True, False, False, False, False, True]))


def test_iou(spark):
    df = spark.sql(
        "SELECT named_struct('x1',0D,'y1',0D,'x2',2D,'y2',2D) a, b FROM VALUES "
        "(named_struct('x1',0D,'y1',0D,'x2',2D,'y2',2D)), (named_struct('x1',1D,'y1',0D,'x2',3D,'y2',2D)),"
        "(named_struct('x1',5D,'y1',5D,'x2',6D,'y2',6D)), (named_struct('x1',1D,'y1',1D,'x2',1D,'y2',1D)) t(b)"
    )
    got = [r[0] for r in df.select(G.box_iou(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1.0, 1 / 3, 0.0, 0.0])
