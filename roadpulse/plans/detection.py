"""Detections to events: class and region filters, projection, trajectory speed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import CORNERS, TO_METRES, corners, matrix, with_projection
from roadpulse.functions.geometry import inside_quad, project
from roadpulse.operators import filters, projections, windows
from roadpulse.operators.joins import with_camera


def located(detections: DataFrame, cameras: DataFrame, minus_one: bool = True) -> DataFrame:
    """Detections inside their camera's region, with metres and the camera's ``fps``, in one lookup.

    A frame rate that is unknown or outside 1 to 60 counts as 25, as when a camera is opened.
    """
    numbers = [*CORNERS, *TO_METRES]
    rate = F.col("fps").cast("double")
    usable = F.when(rate.between(1, C.MAX_FPS), rate).otherwise(F.lit(C.DEFAULT_FPS))
    dimension = with_projection(cameras, minus_one).select("source_id", *numbers, usable.alias("fps"))
    joined = with_camera(detections, dimension).where(
        inside_quad(corners(), F.col("px"), F.col("py"))
    )
    mx, my = project(matrix(TO_METRES), F.col("px"), F.col("py"))
    return joined.withColumns({"mx": mx, "my": my}).drop(*numbers)


def frame_rates(cameras: DataFrame) -> list[float]:
    """The distinct frame rates of the cameras, whole and from 1 to 60, so 60 values at most."""
    whole = F.floor(F.col("fps")).cast("int")
    found = cameras.where(F.col("fps").between(1, C.MAX_FPS)).select(whole.alias("r")).distinct()
    return sorted(float(r["r"]) for r in found.collect())


def tracked_events(detections: DataFrame, cameras: DataFrame) -> DataFrame:
    """Events as the detector publishes them, from tracked detections with pixel anchors.

    Speeds and trajectory lengths follow each camera's frame rate; a track keeps its first class.
    """
    kept = located(filters.class_confidence(detections), cameras)
    moving = windows.endpoint_speed(
        kept, "fps", rates=frame_rates(cameras), first="class_id", sizes=detections
    )
    return projections.event_record(filters.min_trajectory(moving))
