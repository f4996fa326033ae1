"""Filters, projections and scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.cameras import config_violations
from roadpulse.functions import clock, geometry, traffic
from roadpulse.operators import filters, joins, projections, windows
from roadpulse.plans import detection
from roadpulse.sources.streams import decode
from workload import inputs as I
from workload import sql as S
from workload.registry import query

PICK = ["event_id", "source_id", "tracker_id", "vehicle_type", "speed_kmh", "confidence"]
_PICK = ", ".join(PICK)


@query("filter_valid_live", f"WITH {S.DET} SELECT {_PICK} FROM det WHERE {S.LIVE_VALID}")
def filter_valid_live(spark: SparkSession, folder: str) -> DataFrame:
    return filters.valid_live(I.detections(spark, folder)).select(*PICK)


@query("filter_valid_batch", f"WITH {S.DET} SELECT {_PICK} FROM det WHERE {S.BATCH_VALID}")
def filter_valid_batch(spark: SparkSession, folder: str) -> DataFrame:
    return filters.valid_batch(I.detections(spark, folder)).select(*PICK)


@query(
    "filter_parsable_time",
    f"""WITH {S.DECODED} SELECT source_id, tracker_id, frame, date_trunc('second', ts) AS event_time
    FROM decoded WHERE NOT cut AND "timestamp" <> 'not-a-time'""",
)
def filter_parsable_time(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode(I.damaged_messages(spark, folder))
    timed = filters.parsable_time(decoded)
    tracker = F.col("tracker_id").cast("double").alias("tracker_id")
    return timed.select("source_id", tracker, F.col("frame").cast("double").alias("frame"), "event_time")


@query(
    "filter_class_confidence",
    f"""WITH {S.DET} SELECT event_id, class_id, confidence FROM det
    WHERE class_id IN (2, 3, 5, 7) AND confidence > 0.5::DOUBLE""",
)
def filter_class_confidence(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.class_confidence(I.raw_detections(spark, folder))
    return kept.select("event_id", "class_id", "confidence")


@query(
    "filter_roi",
    f"""WITH {S.DET}, {S.CAM} SELECT event_id, source_id, px, py
    FROM det JOIN cam USING (source_id) WHERE {S.INSIDE}""",
)
def filter_roi(spark: SparkSession, folder: str) -> DataFrame:
    kept = filters.in_roi(I.raw_detections(spark, folder), I.cameras(spark))
    return kept.select("event_id", "source_id", "px", "py")


@query(
    "filter_min_trajectory",
    f"""WITH {S.LOCATED}, {S.ENDPOINT}
    SELECT event_id, source_id, tracker_id, points FROM points WHERE points >= 2""",
)
def filter_min_trajectory(spark: SparkSession, folder: str) -> DataFrame:
    moving = windows.endpoint_speed(I.located(spark, folder), "fps", rates=I.RATES)
    return filters.min_trajectory(moving).select("event_id", "source_id", "tracker_id", "points")


@query(
    "filter_plausible_speed",
    f"""WITH {S.LOCATED}, {S.ENDPOINT} SELECT event_id, {S.rnd("speed_kmh", 4)} AS speed_kmh
    FROM points WHERE speed_kmh > 0 AND speed_kmh < 300""",
)
def filter_plausible_speed(spark: SparkSession, folder: str) -> DataFrame:
    moving = filters.plausible(windows.endpoint_speed(I.located(spark, folder), "fps", rates=I.RATES))
    return moving.select("event_id", traffic.rounded(F.col("speed_kmh"), 4).alias("speed_kmh"))


@query(
    "filter_frame_sample",
    f"WITH {S.DET} SELECT event_id, source_id, frame FROM det WHERE frame % 2 = 0",
)
def filter_frame_sample(spark: SparkSession, folder: str) -> DataFrame:
    sampled = filters.frame_sample(I.detections(spark, folder))
    return sampled.select("event_id", "source_id", "frame")


@query(
    "local_time_formats",
    f"""WITH {S.DET} SELECT event_id, date_trunc('second', ts) AS event_time FROM det
    WHERE event_id % 5 <> 4""",
)
def local_time_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Event times as they come: plain, ISO with an offset, in UTC, with a fraction, and broken ones."""
    n, ts = F.col("event_id"), F.date_trunc("second", F.col("ts"))
    utc = ts.cast("timestamp_ntz") - F.expr("interval 7 hours")
    text = (
        F.when(n % 5 == 0, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .when(n % 5 == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+07:00'"))
        .when(n % 5 == 2, F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(n % 5 == 3, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format(ts, "dd/MM/yyyy HH:mm"))
    )
    events = I.detections(spark, folder).withColumn("timestamp", text)
    return filters.parsable_time(events).select("event_id", "event_time")


@query(
    "filter_incidents",
    f"""WITH {S.LIVE} SELECT source_id, window_start, traffic_status FROM live
    WHERE traffic_status <> 'LANCAR'""",
)
def filter_incidents(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.incidents(I.live_hours(spark, folder))
    return rows.select("source_id", "window_start", "traffic_status")


@query(
    "filter_local_day",
    f"""WITH {S.HOURLY} SELECT * FROM total WHERE window_end >= TIMESTAMP '2024-01-15'
    AND window_end < TIMESTAMP '2024-01-16'""",
)
def filter_local_day(spark: SparkSession, folder: str) -> DataFrame:
    return filters.local_day(I.hourly_totals(spark, folder), I.AS_OF)


@query(
    "filter_recent",
    f"WITH {S.HOURLY} SELECT * FROM total WHERE window_start >= {S.NOW} - INTERVAL 1 HOUR",
)
def filter_recent(spark: SparkSession, folder: str) -> DataFrame:
    return filters.recent(I.hourly_totals(spark, folder), I.AS_OF)


@query(
    "validate_camera_config",
    """WITH c AS (SELECT 'cam_' || c_custkey AS source_id, c_custkey AS n,
      CAST(c_custkey * 13 % 1500 AS DOUBLE) AS x, CAST(c_custkey * 7 % 800 AS DOUBLE) AS y
      FROM customer),
    checks AS (
      SELECT source_id, 'roi_points' AS problem FROM c WHERE n % 7 = 0 OR n % 23 = 0
      UNION ALL SELECT source_id, 'roi_outside_frame' FROM c WHERE n % 7 <> 0 AND n % 23 <> 0
        AND ((CASE WHEN n % 11 = 0 THEN 1920 ELSE x + 300 END) >= 1920 OR y + 200 >= 1080)
      UNION ALL SELECT source_id, 'target_size' FROM c WHERE n % 13 = 0 OR n % 19 = 0
      UNION ALL SELECT source_id, 'video_source' FROM c
        WHERE n % 5 = 0 OR (n % 5 > 2 AND n % 17 = 0))
    SELECT * FROM checks""",
)
def validate_camera_config(spark: SparkSession, folder: str) -> DataFrame:
    return config_violations(I.camera_settings(spark, folder))


@query("project_live_row", f"WITH {S.LIVE} SELECT {S.live_row()} FROM live")
def project_live_row(spark: SparkSession, folder: str) -> DataFrame:
    return I.plain_live(I.live_rows(I.live_hours(spark, folder)))


@query(
    "project_snapshot",
    f"""WITH {S.SNAPSHOT} SELECT source_id, total_vehicles, avg_speed, max_speed, traffic_status,
    strftime(last_update - INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S.%gZ') AS last_update FROM snap""",
)
def project_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    shown = I.snapshot(spark, folder)
    return shown.withColumn("last_update", clock.iso_utc(F.col("last_update")))


@query(
    "project_by_type",
    f"""WITH {S.HOURLY} SELECT window_end AS recorded_at, window_end, source_id, vehicle_type,
    vehicle_count, {S.rnd("coalesce(avg_speed_kmh, 0)", 1)} AS avg_speed_kmh FROM kinds""",
)
def project_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return projections.by_type_view(I.hourly_by_type(spark, folder))


@query(
    "project_event_record",
    f"""WITH {S.DET}, {S.CAM},
    loc AS (SELECT det.* EXCLUDE (speed_kmh), fps, {S.METRES} FROM det JOIN cam USING (source_id)
      WHERE class_id IN (2, 3, 5, 7) AND confidence > 0.5::DOUBLE AND {S.INSIDE}),
    {S.ENDPOINT},
    firsts AS (SELECT source_id, tracker_id, arg_min(class_id, frame) AS first_class
      FROM points GROUP BY 1, 2)
    SELECT source_id, tracker_id,
      CASE first_class WHEN 2 THEN 'car' WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus'
        WHEN 7 THEN 'truck' ELSE 'unknown' END AS vehicle_type,
      {S.rnd("speed_kmh", 2)} AS speed_kmh, {S.rnd("confidence", 4)} AS confidence,
      "timestamp", processing_time, frame, {S.rnd("mx", 2)} AS pos_x, {S.rnd("my", 2)} AS pos_y,
      CAST(points AS INTEGER) AS trajectory_length
    FROM points JOIN firsts USING (source_id, tracker_id) WHERE points >= 2""",
)
def project_event_record(spark: SparkSession, folder: str) -> DataFrame:
    return I.flat(detection.tracked_events(I.raw_detections(spark, folder), I.cameras(spark)))


@query("traffic_status", f"WITH {S.LIVE} SELECT {S.LIVE_COLUMNS} FROM live")
def traffic_status(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_live(I.live_hours(spark, folder))


def rounded_live(live: DataFrame) -> DataFrame:
    speeds = ["avg_speed", "max_speed", "min_speed", "avg_confidence"]
    return live.withColumns({c: traffic.rounded(F.col(c), 6) for c in speeds})


@query(
    "class_name",
    f"""WITH {S.DET} SELECT event_id, class_id, CASE class_id WHEN 2 THEN 'car'
    WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' ELSE 'unknown' END
    AS vehicle_type FROM det""",
)
def class_name(spark: SparkSession, folder: str) -> DataFrame:
    raw = I.raw_detections(spark, folder)
    name = traffic.class_name(F.col("class_id")).alias("vehicle_type")
    return raw.select("event_id", "class_id", name)


@query(
    "perspective_transform",
    f"WITH {S.LOCATED} SELECT event_id, {S.rnd('mx', 6)} AS mx, {S.rnd('my', 6)} AS my FROM loc",
)
def perspective_transform(spark: SparkSession, folder: str) -> DataFrame:
    inside = filters.in_roi(I.raw_detections(spark, folder), I.cameras(spark))
    metres = joins.to_metres(inside, I.cameras(spark))
    return metres.select("event_id", *[traffic.rounded(F.col(c), 6).alias(c) for c in ("mx", "my")])


@query(
    "inverse_transform",
    f"""WITH {S.LOCATED},
    back AS (SELECT event_id, (g0 * mx + g1 * my + g2) / (g6 * mx + g7 * my + 1) AS ix,
      (g3 * mx + g4 * my + g5) / (g6 * mx + g7 * my + 1) AS iy
      FROM loc JOIN cam USING (source_id))
    SELECT event_id, {S.rnd("ix", 4)} AS ix, {S.rnd("iy", 4)} AS iy FROM back""",
)
def inverse_transform(spark: SparkSession, folder: str) -> DataFrame:
    back = joins.to_pixels(I.located(spark, folder), I.cameras(spark))
    return back.select("event_id", *[traffic.rounded(F.col(c), 4).alias(c) for c in ("ix", "iy")])


@query(
    "bbox_anchor",
    f"""WITH {S.BOXES} SELECT box_id, (x1 + x2) / 2 AS center_x, (y1 + y2) / 2 AS center_y,
    (x1 + x2) / 2 AS bottom_x, y2 AS bottom_y FROM boxes""",
)
def bbox_anchor(spark: SparkSession, folder: str) -> DataFrame:
    corners = [F.col(c) for c in ("x1", "y1", "x2", "y2")]
    center, bottom = geometry.box_center(*corners), geometry.box_bottom_center(*corners)
    return I.boxes(spark, folder).select(
        "box_id",
        center[0].alias("center_x"),
        center[1].alias("center_y"),
        bottom[0].alias("bottom_x"),
        bottom[1].alias("bottom_y"),
    )


@query(
    "speed_norm",
    f"""WITH {S.DET} SELECT event_id, {S.rnd("least(speed_kmh / 80.0::DOUBLE, 1.0::DOUBLE)", 6)}
    AS heat FROM det WHERE speed_kmh IS NOT NULL""",
)
def speed_norm(spark: SparkSession, folder: str) -> DataFrame:
    known = I.detections(spark, folder).where(F.col("speed_kmh").isNotNull())
    heat = traffic.rounded(traffic.speed_norm(F.col("speed_kmh")), 6).alias("heat")
    return known.select("event_id", heat)


@query(
    "local_time",
    """SELECT event_id, ts AS naive_local, ts + INTERVAL 7 HOUR AS from_utc FROM events""",
)
def local_time(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return I.table(spark, folder, "events").select(
        "event_id",
        clock.local_time(ts).alias("naive_local"),
        clock.local_time(ts, "UTC").alias("from_utc"),
    )


@query(
    "floor_window",
    """WITH w AS (SELECT event_id, date_trunc('hour', ts) AS s FROM events)
    SELECT event_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start,
      strftime(s + INTERVAL 60 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end FROM w""",
)
def floor_window(spark: SparkSession, folder: str) -> DataFrame:
    window = F.window("ts", clock.minutes(60))
    return I.table(spark, folder, "events").select(
        "event_id",
        clock.text_time(window["start"]).alias("window_start"),
        clock.text_time(window["end"]).alias("window_end"),
    )


@query(
    "round_metrics",
    f"""WITH {S.DET} SELECT event_id, {S.rnd("speed_kmh", 2)} AS two, {S.rnd("speed_kmh", 1)} AS one,
    {S.rnd("speed_kmh", 0)} AS whole, {S.rnd("confidence", 4)} AS four FROM det""",
)
def round_metrics(spark: SparkSession, folder: str) -> DataFrame:
    speed = F.col("speed_kmh")
    return I.detections(spark, folder).select(
        "event_id",
        traffic.rounded(speed, 2).alias("two"),
        traffic.rounded(speed, 1).alias("one"),
        traffic.rounded(speed, 0).alias("whole"),
        traffic.rounded(F.col("confidence"), 4).alias("four"),
    )


@query(
    "camera_label",
    f"""WITH {S.DET} SELECT event_id, CASE source_id WHEN 'cam_01' THEN 'Kamera 1'
      WHEN 'cam_02' THEN 'Kamera 2' ELSE source_id END AS label,
      CASE source_id WHEN 'cam_01' THEN 'Simpang Ciawi' ELSE 'Depan Balaikota Bogor' END AS place
    FROM det""",
)
def camera_label(spark: SparkSession, folder: str) -> DataFrame:
    source = F.col("source_id")
    return I.detections(spark, folder).select(
        "event_id",
        traffic.camera_label(source).alias("label"),
        traffic.camera_place(source).alias("place"),
    )


@query(
    "alert_severity",
    f"""WITH {S.LIVE} SELECT source_id, window_start, CASE traffic_status WHEN 'MACET' THEN 'Tinggi'
    ELSE 'Sedang' END AS severity FROM live WHERE traffic_status <> 'LANCAR'""",
)
def alert_severity(spark: SparkSession, folder: str) -> DataFrame:
    severity = traffic.alert_severity(F.col("traffic_status")).alias("severity")
    rows = filters.incidents(I.live_hours(spark, folder))
    return rows.select("source_id", "window_start", severity)


@query(
    "alert_title",
    f"""WITH {S.LIVE} SELECT source_id, window_start, source_id || ' ' || lower(traffic_status)
    AS title, strftime(window_end, '%H:%M') AS time FROM live WHERE traffic_status <> 'LANCAR'""",
)
def alert_title(spark: SparkSession, folder: str) -> DataFrame:
    rows = filters.incidents(I.live_hours(spark, folder))
    return rows.select(
        "source_id",
        "window_start",
        traffic.alert_title(F.col("source_id"), F.col("traffic_status")).alias("title"),
        traffic.alert_time(F.col("window_end")).alias("time"),
    )


@query(
    "load_score",
    f"""WITH {S.LIVE} SELECT source_id, window_start, CAST(least(100, greatest(25,
      floor(100 - {S.rnd("avg_speed", 2)} * 2 + total_count / 2.0::DOUBLE + 0.5))) AS INTEGER)
    AS load FROM live""",
)
def load_score(spark: SparkSession, folder: str) -> DataFrame:
    speed = traffic.rounded(F.col("avg_speed"), 2)
    load = traffic.load_score(speed, F.col("total_count")).alias("load")
    return I.live_hours(spark, folder).select("source_id", "window_start", load)


@query(
    "label_time",
    f"""WITH {S.LIVE} SELECT source_id, window_end, strftime(window_end, '%H:%M:%S') AS label
    FROM live""",
)
def label_time(spark: SparkSession, folder: str) -> DataFrame:
    label = clock.clock_label(F.col("window_end")).alias("label")
    return I.live_hours(spark, folder).select("source_id", "window_end", label)
