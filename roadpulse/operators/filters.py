"""Row filters."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import CORNERS, corners, with_corners
from roadpulse.functions import clock
from roadpulse.functions.geometry import inside_quad
from roadpulse.functions.traffic import plausible_speed
from roadpulse.operators.joins import with_camera


def valid_live(df: DataFrame) -> DataFrame:
    """Rows the live job counts: complete, 0 <= speed < 150, confidence above 0.3."""
    return df.where(
        F.col("source_id").isNotNull()
        & F.col("vehicle_type").isNotNull()
        & F.col("tracker_id").isNotNull()
        & (F.col("speed_kmh") >= 0)
        & (F.col("speed_kmh") < C.MAX_SPEED_KMH)
        & (F.col("confidence") > C.MIN_LIVE_CONFIDENCE)
    )


def valid_batch(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows the hourly job counts: complete, 0 < speed < 150, any confidence.

    Unlike the live job it drops standing vehicles.
    """
    return moving(complete(df, required))


def complete(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Rows with a value in every required column; a speed that is not a number is none."""
    return df.dropna(subset=required or C.REQUIRED_COLUMNS)


def moving(df: DataFrame) -> DataFrame:
    """Rows with 0 < speed < 150."""
    return df.where((F.col("speed_kmh") > 0) & (F.col("speed_kmh") < C.MAX_SPEED_KMH))


def parsable_time(df: DataFrame, text: str = "timestamp", into: str = "event_time") -> DataFrame:
    """Parse the event time and drop rows whose text is not a time.

    Texts with an offset from UTC become local times, others are local already.
    """
    return df.withColumn(into, clock.parse_local_time(F.col(text))).where(F.col(into).isNotNull())


def unparsable_times(df: DataFrame, text: str = "timestamp") -> DataFrame:
    """How many rows have a time (``parsed``), a text that is none (``dropped``), and no text (``absent``)."""
    known = clock.parse_local_time(F.col(text)).isNotNull()
    return df.agg(
        F.count_if(known).alias("parsed"),
        F.count_if(~known & F.col(text).isNotNull()).alias("dropped"),
        F.count_if(F.col(text).isNull()).alias("absent"),
    )


def class_confidence(
    df: DataFrame, threshold: float = C.DETECTION_CONFIDENCE, class_col: str = "class_id"
) -> DataFrame:
    """Detections of a vehicle class above a confidence threshold."""
    return df.where(
        F.col(class_col).isin(list(C.VEHICLE_CLASSES)) & (F.col("confidence") > threshold)
    )


def in_roi(df: DataFrame, cameras: DataFrame, x: str = "px", y: str = "py") -> DataFrame:
    """Detections whose anchor lies inside the polygon of their own camera."""
    joined = with_camera(df, with_corners(cameras).select("source_id", *CORNERS))
    return joined.where(inside_quad(corners(), F.col(x), F.col(y))).drop(*CORNERS)


def min_trajectory(df: DataFrame, points: int = 2, column: str = "points") -> DataFrame:
    """Rows whose trajectory is long enough to have a speed."""
    return df.where(F.col(column) >= points)


def plausible(df: DataFrame, column: str = "speed_kmh") -> DataFrame:
    """Rows with a believable speed."""
    return df.where(plausible_speed(F.col(column)).isNotNull())


def frame_sample(df: DataFrame, every: int = 2, column: str = "frame") -> DataFrame:
    """Every n-th frame."""
    return df.where(F.col(column) % every == 0)


def incidents(df: DataFrame, status: str = "traffic_status") -> DataFrame:
    """Cameras that are not free-flowing; an unknown state counts as free."""
    return df.where(is_incident(status))


def is_incident(status: str = "traffic_status") -> Column:
    return F.coalesce(F.col(status), F.lit(C.STATUS_FREE)) != C.STATUS_FREE


def between(column: Column, start: datetime, end: datetime) -> Column:
    """Half-open range with the column left bare, so that scans can prune on it."""
    return (column >= clock.ntz(start)) & (column < clock.ntz(end))


def local_day(
    df: DataFrame, as_of: datetime, column: str = "window_end", zone: str = C.ZONE
) -> DataFrame:
    """Rows of the local day that holds ``as_of``."""
    return df.where(between(F.col(column), *clock.local_day_bounds(as_of, zone)))


def recent(
    df: DataFrame,
    as_of: datetime,
    back: timedelta = timedelta(hours=1),
    column: str = "window_start",
) -> DataFrame:
    """Rows not older than ``back`` before ``as_of``."""
    return df.where(F.col(column) >= clock.ntz(as_of - back))
