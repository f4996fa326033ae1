"""Camera configuration as a dimension table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions import geometry as G

_POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
_CAMERA = pa.schema(
    [
        ("source_id", pa.string()),
        ("roi", pa.list_(_POINT)),
        ("target_w", pa.float64()),
        ("target_h", pa.float64()),
        ("fps", pa.float64()),
        ("frame_w", pa.int32()),
        ("frame_h", pa.int32()),
        ("label", pa.string()),
        ("is_active", pa.bool_()),
    ]
)


def camera_table(spark: SparkSession, cameras: list[dict] | None = None) -> DataFrame:
    """Camera dimension from a list of settings.

    The list becomes a local relation of known size, so Catalyst itself broadcasts it while it
    is below the threshold and falls back to a shuffle join beyond it.
    """
    rows = []
    for camera in C.CAMERAS if cameras is None else cameras:
        row = {
            "fps": C.DEFAULT_FPS,
            "frame_w": 1920,
            "frame_h": 1080,
            "label": C.CAMERA_LABELS.get(camera["source_id"], camera["source_id"]),
            "is_active": True,
            **camera,
        }
        row["roi"] = [{"x": float(x), "y": float(y)} for x, y in row["roi"]]
        rows.append(row)
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=_CAMERA))


# Corners and matrices travel as plain number columns. Reading them out of arrays for every
# detection made the generated code so large that the JVM would only interpret it.
CORNERS = [f"roi_{axis}{i}" for i in range(4) for axis in "xy"]
TO_METRES = [f"to_metres_{i}" for i in range(9)]
TO_PIXELS = [f"to_pixels_{i}" for i in range(9)]


def corners() -> list[tuple[Column, Column]]:
    return [(F.col(f"roi_x{i}"), F.col(f"roi_y{i}")) for i in range(4)]


def matrix(columns: list[str]) -> list[Column]:
    return [F.col(c) for c in columns]


def with_corners(cameras: DataFrame) -> DataFrame:
    """Add the region's corners as columns; null where the region has no such corner."""
    points = {f"roi_{axis}{i}": F.get("roi", F.lit(i))[axis] for i in range(4) for axis in "xy"}
    return cameras.withColumns(points)


def with_projection(cameras: DataFrame, minus_one: bool = True) -> DataFrame:
    """Add corners and both projections, pixels to metres and back.

    ``minus_one`` spans the target over (w-1) x (h-1) as in production; calibration uses w x h.
    """
    span = 1.0 if minus_one else 0.0
    width = F.col("target_w") - F.lit(span)
    height = F.col("target_h") - F.lit(span)
    to_quad = G.square_to_quad(corners())
    to_square = G.adjugate(to_quad)
    to_metres = (
        [value * width for value in to_square[0:3]]
        + [value * height for value in to_square[3:6]]
        + to_square[6:9]
    )
    scale = [width, height, F.lit(1.0)] * 3
    to_pixels = [F.try_divide(value, by) for value, by in zip(to_quad, scale)]
    return with_corners(cameras).withColumns(
        dict(zip(TO_METRES + TO_PIXELS, to_metres + to_pixels))
    )


def config_violations(cameras: DataFrame) -> DataFrame:
    """One row (source_id, problem) per broken rule of a camera setting.

    Rules: exactly four corners, each inside the frame; positive target size; the video source
    is a stream address or a file path. A setting that is null breaks its rule.
    """
    outside = F.exists(
        "roi",
        lambda p: (p["x"] < 0)
        | (p["x"] >= F.col("frame_w"))
        | (p["y"] < 0)
        | (p["y"] >= F.col("frame_h")),
    )
    address = F.trim(F.coalesce(F.col("video_source"), F.lit("")))
    stream = address.rlike("(?i)^(https?|rtsp|rtmp)://")
    problems = {
        "roi_points": F.size("roi") != 4,
        "roi_outside_frame": F.coalesce(F.size("roi") == 4, F.lit(False)) & outside,
        "target_size": (F.col("target_w") <= 0) | (F.col("target_h") <= 0),
        "video_source": ~stream & ((address == "") | address.contains("://")),
    }
    found = F.array_compact(
        F.array(
            *[F.when(F.coalesce(broken, F.lit(True)), F.lit(name)) for name, broken in problems.items()]
        )
    )
    return cameras.select("source_id", F.explode(found).alias("problem"))
