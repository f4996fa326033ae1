"""Row-wise reshaping between the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions import clock
from roadpulse.functions.traffic import class_name, rounded


def _decimal(name: str, precision: int, scale: int) -> Column:
    # A value too wide for the column becomes null instead of failing the whole batch.
    return rounded(F.col(name), scale).try_cast(f"decimal({precision},{scale})").alias(name)


def live_row(windows: DataFrame, stamp: Column) -> DataFrame:
    """Live windows in the types of the published table."""
    return windows.select(
        "source_id",
        "window_start",
        "window_end",
        F.col("total_count").cast("int").alias("total_count"),
        _decimal("avg_speed", 6, 2),
        _decimal("max_speed", 6, 2),
        _decimal("min_speed", 6, 2),
        _decimal("avg_confidence", 4, 3),
        "traffic_status",
        stamp.alias("created_at"),
        stamp.alias("updated_at"),
    )


def snapshot_view(live: DataFrame) -> DataFrame:
    """Published live rows as the dashboard shows them: no null metrics, default status."""

    def number(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name)

    status = F.when(F.col("traffic_status") != "", F.col("traffic_status"))
    return live.select(
        "source_id",
        F.coalesce("total_count", F.lit(0)).alias("total_vehicles"),
        number("avg_speed"),
        number("max_speed"),
        F.coalesce(status, F.lit(C.STATUS_FREE)).alias("traffic_status"),
        F.col("updated_at").alias("last_update"),
    )


def by_type_view(by_type: DataFrame) -> DataFrame:
    """Hourly rows by type as the dashboard shows them."""
    return by_type.select(
        F.col("window_end").alias("recorded_at"),
        "window_end",
        "source_id",
        "vehicle_type",
        F.coalesce("vehicle_count", F.lit(0)).alias("vehicle_count"),
        rounded(F.coalesce("avg_speed_kmh", F.lit(0.0)), 1).alias("avg_speed_kmh"),
    )


def event_record(df: DataFrame) -> DataFrame:
    """Tracked points with a speed as detection events, rounded as they are published."""
    return df.select(
        "source_id",
        "tracker_id",
        class_name(F.col("class_id")).alias("vehicle_type"),
        rounded(F.col("speed_kmh"), 2).alias("speed_kmh"),
        rounded(F.col("confidence"), 4).alias("confidence"),
        clock.text_time(F.col("ts")).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processing_time"),
        "frame",
        F.struct(rounded(F.col("mx"), 2).alias("x"), rounded(F.col("my"), 2).alias("y")).alias(
            "position_meters"
        ),
        F.col("points").cast("int").alias("trajectory_length"),
    )
