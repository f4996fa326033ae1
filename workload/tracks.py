"""Trajectories, classes, overlaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.traffic import rounded
from roadpulse.operators import overlap, windows
from workload import inputs as I
from workload import sql as S
from workload.registry import query


def _rounded(df: DataFrame, keys: list[str], digits: int, *columns: str) -> DataFrame:
    return df.select(*keys, *[rounded(F.col(c), digits).alias(c) for c in columns])


@query(
    "win_speed_endpoint",
    f"""WITH {S.LOCATED}, {S.ENDPOINT}
    SELECT event_id, points, {S.rnd("speed_kmh", 4)} AS speed_kmh FROM points""",
)
def win_speed_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    speeds = windows.endpoint_speed(I.located(spark, folder), "fps", rates=I.RATES)
    return _rounded(speeds, ["event_id", "points"], 4, "speed_kmh")


@query(
    "win_speed_path",
    f"""WITH {S.LOCATED}, {S.PATH}
    SELECT event_id, points, {S.rnd("path_speed_kmh", 4)} AS path_speed_kmh FROM paths""",
)
def win_speed_path(spark: SparkSession, folder: str) -> DataFrame:
    speeds = windows.path_speed(I.located(spark, folder), "fps", gap=I.SESSION_GAP)
    return _rounded(speeds, ["event_id", "points"], 4, "path_speed_kmh")


@query(
    "win_speed_smooth",
    f"""WITH {S.LOCATED}, {S.PATH}
    SELECT event_id, {S.rnd("path_speed_kmh", 4)} AS path_speed_kmh,
      {S.rnd('''CASE WHEN count(path_speed_kmh) OVER w >= 3 THEN avg(path_speed_kmh) OVER w
      ELSE path_speed_kmh END''', 4)} AS smooth_speed_kmh
    FROM paths WINDOW w AS ({S.VISIT} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def win_speed_smooth(spark: SparkSession, folder: str) -> DataFrame:
    speeds = windows.smooth_speed(I.located(spark, folder), "fps", gap=I.SESSION_GAP)
    return _rounded(speeds, ["event_id"], 4, "path_speed_kmh", "smooth_speed_kmh")


_ODD = f"""{S.DET}, {S.CAM},
  loc AS (SELECT * REPLACE (CASE WHEN event_id % 397 = 5 THEN 1e12::DOUBLE WHEN event_id % 401 = 7
      THEN 'nan'::DOUBLE ELSE mx END AS mx)
    FROM (SELECT det.* EXCLUDE (speed_kmh), fps, {S.METRES} FROM det JOIN cam USING (source_id) WHERE {S.INSIDE}))"""


@query(
    "win_speed_recovers",
    f"""WITH {_ODD}, {S.PATH}
    SELECT event_id, path_speed_kmh, CASE WHEN count(path_speed_kmh) OVER w >= 3
      THEN avg(path_speed_kmh) OVER w ELSE path_speed_kmh END AS smooth_speed_kmh
    FROM paths WINDOW w AS ({S.VISIT} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def win_speed_recovers(spark: SparkSession, folder: str) -> DataFrame:
    """Some points far off and some that are not a number: speeds recover once these have left."""
    n = F.col("event_id")
    far = F.when(n % 397 == 5, F.lit(1e12)).when(n % 401 == 7, F.lit(float("nan"))).otherwise(F.col("mx"))
    odd = I.located(spark, folder).withColumn("mx", far)
    speeds = windows.smooth_speed(odd, "fps", gap=I.SESSION_GAP)
    return speeds.select("event_id", "path_speed_kmh", "smooth_speed_kmh")


@query(
    "win_first_class",
    f"""WITH {S.DET} SELECT source_id, tracker_id, arg_min(class_id, frame) AS class_id
    FROM det WHERE source_id IS NOT NULL GROUP BY 1, 2""",
)
def win_first_class(spark: SparkSession, folder: str) -> DataFrame:
    known = I.raw_detections(spark, folder).where(F.col("source_id").isNotNull())
    return windows.first_class(known)


@query(
    "win_last_class",
    f"""WITH {S.LOCATED},
    latest AS (SELECT source_id, tracker_id, max(frame) AS frame,
      arg_max(class_id, frame) AS class_id, arg_max(mx, frame) AS mx, arg_max(my, frame) AS my
      FROM loc GROUP BY 1, 2)
    SELECT source_id, tracker_id, frame, class_id, CASE class_id WHEN 2 THEN 'car'
      WHEN 3 THEN 'motorcycle' WHEN 5 THEN 'bus' WHEN 7 THEN 'truck' ELSE 'unknown' END
      AS vehicle_type, {S.rnd("mx", 6)} AS mx, {S.rnd("my", 6)} AS my FROM latest""",
)
def win_last_class(spark: SparkSession, folder: str) -> DataFrame:
    latest = windows.last_seen(I.located(spark, folder))
    keys = ["source_id", "tracker_id", "frame", "class_id", "vehicle_type"]
    return _rounded(latest, keys, 6, "mx", "my")


@query(
    "win_trajectory_array",
    f"""WITH {S.LOCATED}, {S.VISITED},
    lists AS (SELECT event_id, list(CAST({S.rnd("mx * 100", 0)} AS BIGINT)) OVER w AS xs,
      list(CAST({S.rnd("my * 100", 0)} AS BIGINT)) OVER w AS ys FROM visited
      WINDOW w AS ({S.VISIT} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
    SELECT event_id, CAST(len(xs) AS INTEGER) AS points, array_to_string(xs, ',') AS xs_cm,
      array_to_string(ys, ',') AS ys_cm FROM lists""",
)
def win_trajectory_array(spark: SparkSession, folder: str) -> DataFrame:
    lists = windows.trajectory_array(I.located(spark, folder), gap=I.SESSION_GAP)

    def centimetres(axis: str):
        value = F.transform("trajectory", lambda p: rounded(p[axis] * 100, 0).cast("bigint"))
        return F.array_join(value.cast("array<string>"), ",").alias(f"{axis}s_cm")

    return lists.select(
        "event_id", F.size("trajectory").alias("points"), centimetres("x"), centimetres("y")
    )


_MEANS = ", ".join(f"{S.rnd(f'avg({c}) OVER w', 6)} AS {c}" for c in ("x1", "y1", "x2", "y2"))


@query(
    "win_detection_smoothing",
    f"""WITH {S.BOXES}, known AS (SELECT * FROM boxes WHERE source_id IS NOT NULL)
    SELECT box_id, {_MEANS} FROM known
    WINDOW w AS (PARTITION BY source_id, tracker_id ORDER BY box_id
      ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def win_detection_smoothing(spark: SparkSession, folder: str) -> DataFrame:
    known = I.boxes(spark, folder).where(F.col("source_id").isNotNull())
    smooth = windows.smooth_boxes(known, order="box_id")
    return _rounded(smooth, ["box_id"], 6, "x1", "y1", "x2", "y2")


@query(
    "heat_layer",
    f"""WITH {S.LOCATED}, {S.PATH},
    smooth AS (SELECT *, CASE WHEN count(path_speed_kmh) OVER w >= 3
        THEN avg(path_speed_kmh) OVER w ELSE path_speed_kmh END AS speed_kmh
      FROM paths WINDOW w AS ({S.VISIT} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
    final AS (SELECT * FROM smooth QUALIFY row_number() OVER
      (PARTITION BY source_id, tracker_id ORDER BY frame DESC) = 1)
    SELECT source_id, tracker_id, {S.rnd("mx", 6)} AS mx, {S.rnd("my", 6)} AS my,
      {S.rnd("speed_kmh", 4)} AS speed_kmh,
      {S.rnd("least(speed_kmh / 80.0::DOUBLE, 1.0::DOUBLE)", 4)} AS heat
    FROM final WHERE speed_kmh > 0 AND speed_kmh < 300""",
)
def heat_layer(spark: SparkSession, folder: str) -> DataFrame:
    smooth = windows.smooth_speed(I.located(spark, folder), "fps", gap=I.SESSION_GAP)
    heat = windows.heat_points(smooth, speed="smooth_speed_kmh")
    heat = heat.withColumnRenamed("smooth_speed_kmh", "speed_kmh")
    placed = _rounded(heat, ["source_id", "tracker_id", "speed_kmh", "heat"], 6, "mx", "my")
    return _rounded(placed, ["source_id", "tracker_id", "mx", "my"], 4, "speed_kmh", "heat")


_IOU = """(greatest(least(k.x2, r.x2) - greatest(k.x1, r.x1), 0)
  * greatest(least(k.y2, r.y2) - greatest(k.y1, r.y1), 0))"""
_UNION = f"((k.x2 - k.x1) * (k.y2 - k.y1) + (r.x2 - r.x1) * (r.y2 - r.y1) - {_IOU})"
_BOX = "{'box_id': r.box_id, 'x1': r.x1, 'y1': r.y1, 'x2': r.x2, 'y2': r.y2}"


@query(
    "nms_frame",
    f"""WITH RECURSIVE {S.BOXES},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY source_id, frame, class_id
      ORDER BY confidence DESC, box_id) AS place FROM boxes),
    walk AS (
      SELECT r.source_id, r.frame, r.class_id, r.place, [{_BOX}] AS kept FROM ranked r WHERE place = 1
      UNION ALL
      SELECT r.source_id, r.frame, r.class_id, r.place,
        CASE WHEN len(list_filter(w.kept, lambda k: {_IOU} / {_UNION} > 0.7::DOUBLE)) > 0
          THEN w.kept ELSE list_append(w.kept, {_BOX}) END
      FROM walk w JOIN ranked r
        ON r.source_id IS NOT DISTINCT FROM w.source_id AND r.frame = w.frame
        AND r.class_id = w.class_id AND r.place = w.place + 1),
    final AS (SELECT * FROM walk
      QUALIFY row_number() OVER (PARTITION BY source_id, frame, class_id ORDER BY place DESC) = 1),
    ids AS (SELECT unnest(kept).box_id AS box_id FROM final)
    SELECT box_id, source_id, frame, class_id, confidence, x1, y1, x2, y2
    FROM boxes JOIN ids USING (box_id)""",
)
def nms_frame(spark: SparkSession, folder: str) -> DataFrame:
    kept = overlap.suppress_overlaps(I.boxes(spark, folder))
    return kept.select("box_id", "source_id", "frame", "class_id", "confidence", "x1", "y1", "x2", "y2")
