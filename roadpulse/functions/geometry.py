"""Plane geometry as column arithmetic: projection, polygons, boxes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def square_to_quad(corners: list[tuple[Column, Column]]) -> list[Column]:
    """3x3 matrix, row by row, that maps the unit square onto four corners.

    Corners are given for (0,0), (1,0), (1,1), (0,1). The closed form needs no solver, so
    it runs for any number of cameras inside the plan.
    """
    (x0, y0), (x1, y1), (x2, y2), (x3, y3) = corners
    dx1, dx2, sx = x1 - x2, x3 - x2, x0 - x1 + x2 - x3
    dy1, dy2, sy = y1 - y2, y3 - y2, y0 - y1 + y2 - y3
    area = F.nullif(dx1 * dy2 - dx2 * dy1, F.lit(0.0))
    g = (sx * dy2 - dx2 * sy) / area
    h = (dx1 * sy - sx * dy1) / area
    return [
        x1 - x0 + g * x1, x3 - x0 + h * x3, x0,
        y1 - y0 + g * y1, y3 - y0 + h * y3, y0,
        g, h, F.lit(1.0),
    ]


def adjugate(m: list[Column]) -> list[Column]:
    """Inverse of a 3x3 matrix up to a factor, which a projection ignores."""
    a, b, c, d, e, f, g, h, i = m
    return [
        e * i - f * h, c * h - b * i, b * f - c * e,
        f * g - d * i, a * i - c * g, c * d - a * f,
        d * h - e * g, b * g - a * h, a * e - b * d,
    ]


def project(m: list[Column], x: Column, y: Column) -> tuple[Column, Column]:
    """Point (x, y) after the projection ``m``; null where the point has no image."""
    depth = m[6] * x + m[7] * y + m[8]
    across, along = m[0] * x + m[1] * y + m[2], m[3] * x + m[4] * y + m[5]
    return F.try_divide(across, depth), F.try_divide(along, depth)


def inside_quad(corners: list[tuple[Column, Column]], x: Column, y: Column) -> Column:
    """Even-odd ray casting over the four edges.

    Unrolled, and the parity is taken with boolean inequality instead of a sum of cases: the
    generated method has to stay small enough for the JVM to compile it.
    """
    above = [yc > y for _, yc in corners]

    def crosses(a: int, b: int) -> Column:
        (xa, ya), (xb, yb) = corners[a], corners[b]
        at = xa + F.try_divide((y - ya) * (xb - xa), yb - ya)
        return (above[a] != above[b]) & (x < at)

    first, second, third, fourth = crosses(0, 1), crosses(1, 2), crosses(2, 3), crosses(3, 0)
    return (first != second) != (third != fourth)


def box_center(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
    return (x1 + x2) / 2, (y1 + y2) / 2


def box_bottom_center(x1: Column, y1: Column, x2: Column, y2: Column) -> tuple[Column, Column]:
    return (x1 + x2) / 2, y2


def box_iou(a, b) -> Column:
    """Intersection over union of two structs with fields x1, y1, x2, y2."""
    zero = F.lit(0.0)
    width = F.greatest(F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]), zero)
    height = F.greatest(F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]), zero)
    shared = width * height
    area_a = (a["x2"] - a["x1"]) * (a["y2"] - a["y1"])
    area_b = (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])
    return F.coalesce(shared / F.nullif(area_a + area_b - shared, zero), zero)
