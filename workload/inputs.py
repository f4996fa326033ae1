"""Traffic inputs as projections of the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import camera_table
from roadpulse.functions import clock
from roadpulse.operators import aggregates, filters, projections
from roadpulse.plans import detection, hourly
from roadpulse.schema import EVENT_SCHEMA

AS_OF = datetime(2024, 1, 15, 12, 0, 0)
EARLIER = datetime(2024, 1, 15, 11, 0, 0)
HOUR = "1 hour"
SESSION_GAP = "12 hours"

# Event types stand for detector classes; 0 is no vehicle.
TYPES = {"click": "car", "view": "motorcycle", "purchase": "bus", "error": "truck"}
CLASSES = {"click": 2, "view": 3, "purchase": 5, "error": 7}

CAMERAS = [
    C.CAMERAS[0],
    {**C.CAMERAS[1], "fps": 30.0},
    {**C.CALIBRATION_CAMERAS[0], "source_id": "cam_03", "fps": 10.0},
    {
        "source_id": "cam_04",
        "roi": [(400, 150), (1400, 150), (1400, 570), (400, 570)],
        "target_w": 30.0,
        "target_h": 40.0,
    },
    # On the roster, but without any event.
    {
        "source_id": "cam_05",
        "roi": [(400, 150), (1400, 150), (1400, 570), (400, 570)],
        "target_w": 30.0,
        "target_h": 40.0,
    },
]
RATES = sorted({camera.get("fps", C.DEFAULT_FPS) for camera in CAMERAS})
ROSTER = [camera["source_id"] for camera in CAMERAS]
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cameras(spark: SparkSession) -> DataFrame:
    return camera_table(spark, CAMERAS)


def _choose(key: Column, options: dict, default) -> Column:
    chosen = F.lit(default)
    for value, result in options.items():
        chosen = F.when(key == value, F.lit(result)).otherwise(chosen)
    return chosen


def detections(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Decoded detection events, with the row key ``event_id`` and the zone-less time ``ts``.

    ``tasks`` deals the table's rows out to so many tasks before anything is made of them: one task reads a
    whole row group, of which a file may have a single one.
    """
    e = table(spark, folder, "events")
    e = e if tasks is None else e.repartition(tasks)
    n = F.col("event_id")
    source = F.concat(F.lit("cam_0"), (F.col("user_id") % 4 + 1).cast("string"))
    return e.select(
        "event_id",
        F.when(n % 211 != 0, source).alias("source_id"),
        F.col("user_id").cast("int").alias("tracker_id"),
        _choose(F.col("event_type"), TYPES, C.UNKNOWN_TYPE).alias("vehicle_type"),
        F.when(n % 89 == 0, F.lit(None))
        .when(n % 307 == 0, 0.0)
        .otherwise(F.col("value") * F.lit(0.4))
        .alias("speed_kmh"),
        ((n * 37 % 101).cast("double") / F.lit(100.0)).alias("confidence"),
        "ts",
        clock.text_time(F.col("ts")).alias("timestamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processing_time"),
        n.cast("int").alias("frame"),
        F.struct((n % 7).cast("double").alias("x"), (n % 23).cast("double").alias("y")).alias(
            "position_meters"
        ),
        (n % 25 + 2).cast("int").alias("trajectory_length"),
    )


def flat(df: DataFrame) -> DataFrame:
    """Event columns with the nested position spread out."""
    plain = [c for c in EVENT_COLUMNS if c != "position_meters"]
    return df.select(
        *plain, F.col("position_meters.x").alias("pos_x"), F.col("position_meters.y").alias("pos_y")
    )


def flat_nullable(df: DataFrame) -> DataFrame:
    """``flat`` with nullable integers as doubles, which every engine compares alike."""
    numbers = ["tracker_id", "frame", "trajectory_length"]
    return flat(df).withColumns({c: F.col(c).cast("double") for c in numbers})


def plain_live(df: DataFrame) -> DataFrame:
    """Published live rows with decimals as doubles."""
    metrics = ["avg_speed", "max_speed", "min_speed", "avg_confidence"]
    return df.withColumns({c: F.col(c).cast("double") for c in metrics})


def messages(df: DataFrame) -> DataFrame:
    """Detections as JSON messages."""
    return df.select(
        "event_id",
        F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"}).alias("value"),
    )


def undamaged(df: DataFrame) -> DataFrame:
    """Detections whose messages stay whole."""
    n = F.col("event_id")
    return df.where((n % 97 != 0) & (n % 101 != 0) & (n % 103 != 0))


def damaged_messages(spark: SparkSession, folder: str, tasks: int | None = None) -> DataFrame:
    """Messages of all detections, some of them damaged."""
    return damaged(detections(spark, folder, tasks))


def damaged(df: DataFrame) -> DataFrame:
    """Messages of which some are cut, carry a bad time or tracker, or an unknown field."""
    n, value = F.col("event_id"), F.col("value")
    return messages(df).select(
        F.when(n % 97 == 0, F.substring(value, 1, 20))
        .when(
            n % 101 == 0,
            F.regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"not-a-time"'),
        )
        .when(n % 103 == 0, F.regexp_replace(value, '"tracker_id":[0-9]+', '"tracker_id":"x"'))
        .when(n % 107 == 0, F.regexp_replace(value, r"^\{", '{"note":"extra",'))
        .otherwise(value)
        .alias("value")
    )


def raw_detections(spark: SparkSession, folder: str) -> DataFrame:
    """Detections before tracking: class id and anchor pixel."""
    n = F.col("event_id")
    e = detections(spark, folder)
    class_of = {TYPES[k]: CLASSES[k] for k in TYPES}
    return e.select(
        "event_id",
        "source_id",
        "tracker_id",
        _choose(F.col("vehicle_type"), class_of, 0).alias("class_id"),
        "confidence",
        "ts",
        "frame",
        (n * 7919 % 1000 + 400).cast("double").alias("px"),
        (n * 104729 % 420 + 150).cast("double").alias("py"),
    )


def located(spark: SparkSession, folder: str) -> DataFrame:
    """Raw detections inside their region, in metres."""
    return detection.located(raw_detections(spark, folder), cameras(spark))


def boxes(spark: SparkSession, folder: str) -> DataFrame:
    """Boxes, eight to a frame."""
    n = F.col("event_id")
    cx, cy = (n * 31 % 40 + 600).cast("double"), (n * 17 % 30 + 300).cast("double")
    w, h = (n % 30 + 120).cast("double"), (n % 20 + 90).cast("double")
    return raw_detections(spark, folder).select(
        n.alias("box_id"),
        F.floor(n / 8).cast("int").alias("frame"),
        "source_id",
        "tracker_id",
        "class_id",
        "confidence",
        (cx - w / 2).alias("x1"),
        (cy - h / 2).alias("y1"),
        (cx + w / 2).alias("x2"),
        (cy + h / 2).alias("y2"),
    )


def camera_settings(spark: SparkSession, folder: str) -> DataFrame:
    """One camera setting per customer, some of them broken."""
    n = F.col("c_custkey")
    left, top = (n * 13 % 1500).cast("double"), (n * 7 % 800).cast("double")

    def point(x: Column, y: Column) -> Column:
        return F.struct(x.alias("x"), y.alias("y"))

    right = F.when(n % 11 == 0, F.lit(1920.0)).otherwise(left + 300)
    quad = F.array(
        point(left, top), point(right, top), point(right, top + 200), point(left, top + 200)
    )
    return table(spark, folder, "customer").select(
        F.concat(F.lit("cam_"), n.cast("string")).alias("source_id"),
        F.when(n % 23 == 0, F.lit(None)).when(n % 7 == 0, F.slice(quad, 1, 3)).otherwise(quad).alias("roi"),
        F.when(n % 19 == 0, F.lit(None)).when(n % 13 == 0, 0.0).otherwise((n % 20 + 3).cast("double")).alias("target_w"),
        F.lit(20.0).alias("target_h"),
        F.lit(1920).alias("frame_w"),
        F.lit(1080).alias("frame_h"),
        F.when(n % 5 == 0, F.lit("ftp://host/stream"))
        .when(n % 5 == 1, F.lit("RTSP://host/stream"))
        .when(n % 5 == 2, F.lit("https://host/a.m3u8"))
        .when(n % 17 == 0, F.lit(" "))
        .otherwise(F.lit("video/a.mp4"))
        .alias("video_source"),
    )


def live_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Live windows of one hour with exact vehicle counts."""
    valid = filters.valid_live(detections(spark, folder))
    return aggregates.live_windows(valid, HOUR, time="ts", exact=True)


def live_rows(windows: DataFrame, stamp: datetime = AS_OF) -> DataFrame:
    return projections.live_row(windows, clock.ntz(stamp))


def snapshot_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The published current row per camera."""
    return live_rows(aggregates.latest_per_source(live_hours(spark, folder)))


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's current row per camera."""
    return projections.snapshot_view(snapshot_rows(spark, folder))


def hourly_totals(spark: SparkSession, folder: str) -> DataFrame:
    return hourly.totals(detections(spark, folder))


def hourly_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return hourly.by_type(detections(spark, folder))
