"""Aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import clock
from roadpulse.functions.traffic import rounded
from roadpulse.operators import aggregates, filters
from roadpulse.plans import hourly
from roadpulse.session import written_out
from workload import inputs as I
from workload import sql as S
from workload.registry import query
from workload.rows import rounded_live

_ROUNDED = S.LIVE_COLUMNS


@query("agg_live_5s", f"WITH {S.DET}, {S.live_windows(5)} SELECT {_ROUNDED} FROM live")
def agg_live_5s(spark: SparkSession, folder: str) -> DataFrame:
    """Counts are approximate; in windows of 5 seconds they are small and must be right."""
    valid = filters.valid_live(I.detections(spark, folder))
    return rounded_live(aggregates.live_windows(valid, time="ts"))


@query("agg_live_5s_exact", f"WITH {S.LIVE} SELECT {_ROUNDED} FROM live")
def agg_live_5s_exact(spark: SparkSession, folder: str) -> DataFrame:
    valid = filters.valid_live(I.detections(spark, folder))
    return rounded_live(aggregates.live_windows(valid, I.HOUR, time="ts", exact=True))


@query(
    "rollup_latest_per_source",
    f"""WITH {S.LIVE}, {S.newest("live", "latest")},
    maxima AS (SELECT source_id, max(window_start) AS window_start, max(window_end) AS window_end,
      max(total_count) AS total_count, max(avg_speed) AS avg_speed, max(max_speed) AS max_speed,
      min(min_speed) AS min_speed, max(avg_confidence) AS avg_confidence,
      arg_max(traffic_status, window_start) AS traffic_status FROM live GROUP BY 1)
    SELECT 'latest' AS mode, {_ROUNDED} FROM latest
    UNION ALL SELECT 'componentwise', {_ROUNDED} FROM maxima""",
)
def rollup_latest_per_source(spark: SparkSession, folder: str) -> DataFrame:
    live = I.live_hours(spark, folder)
    modes = [
        aggregates.latest_per_source(live, mode).withColumn("mode", F.lit(mode))
        for mode in ("latest", "componentwise")
    ]
    return rounded_live(modes[0].unionByName(modes[1]))


_VEHICLE_COLUMNS = f"""window_start, source_id, tracker_id, vehicle_type,
  {S.rnd("avg_speed", 6)} AS avg_speed, count_observations, min_speed, max_speed"""


@query("agg_vehicle_level", f"WITH {S.DET}, {S.vehicles()} SELECT {_VEHICLE_COLUMNS} FROM veh")
def agg_vehicle_level(spark: SparkSession, folder: str) -> DataFrame:
    events = hourly.clean_events(I.detections(spark, folder))
    return aggregates.vehicle_level(events).withColumn("avg_speed", rounded(F.col("avg_speed"), 6))


@query("agg_total_summary", f"WITH {S.HOURLY} SELECT * FROM total")
def agg_total_summary(spark: SparkSession, folder: str) -> DataFrame:
    return hourly.totals(I.detections(spark, folder))


@query("agg_type_summary", f"WITH {S.HOURLY} SELECT * FROM kinds")
def agg_type_summary(spark: SparkSession, folder: str) -> DataFrame:
    return hourly.by_type(I.detections(spark, folder))


@query(
    "agg_source_tracker_stats",
    f"""WITH {S.HOURLY} SELECT source_id, count(DISTINCT tracker_id) AS unique_trackers,
    CAST(sum(count_observations) AS BIGINT) AS total_observations FROM veh GROUP BY 1""",
)
def agg_source_tracker_stats(spark: SparkSession, folder: str) -> DataFrame:
    vehicles = aggregates.vehicle_means(hourly.clean_events(I.detections(spark, folder)))
    return aggregates.source_tracker_stats(vehicles)


@query(
    "agg_window_range",
    f"""WITH {S.DET},
    marked AS (SELECT *, date_trunc('hour', ts) AS w, source_id IS NOT NULL AND tracker_id IS NOT NULL
      AND speed_kmh IS NOT NULL AS complete,
      coalesce({S.BATCH_VALID}, false) AS kept FROM det)
    SELECT count(*) AS rows_read, CAST(count_if(complete) AS BIGINT) AS rows_complete,
      CAST(count_if(kept) AS BIGINT) AS rows_kept,
      min(w) FILTER (WHERE kept) AS first_window, max(w) FILTER (WHERE kept) AS last_window,
      count(DISTINCT (w, source_id, tracker_id)) FILTER (WHERE kept) AS unique_vehicles
    FROM marked""",
)
def agg_window_range(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.window_range(I.detections(spark, folder), time="ts")


@query(
    "agg_filter_counts",
    f"""WITH {S.DET},
    marked AS (SELECT *, date_trunc('hour', ts) AS w, source_id IS NOT NULL AND tracker_id IS NOT NULL
      AND speed_kmh IS NOT NULL AS complete, coalesce({S.BATCH_VALID}, false) AS kept FROM det)
    SELECT count(*) AS rows_read, CAST(count_if(complete) AS BIGINT) AS rows_complete,
      CAST(count_if(kept) AS BIGINT) AS rows_kept, min(w) FILTER (WHERE kept) AS first_window,
      max(w) FILTER (WHERE kept) AS last_window FROM marked""",
)
def agg_filter_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The same counts, observed while the vehicle rows are written."""
    kept, seen = aggregates.counted_filters(I.detections(spark, folder), time="ts")
    written_out(aggregates.vehicle_means(kept, time="ts"), "vehicles")
    return aggregates.filter_counts(spark, seen)


@query(
    "dq_duplicate_windows",
    f"""WITH {S.DET} SELECT source_id, date_trunc('hour', ts) AS window_start,
    count(*) AS dup_count FROM det GROUP BY 1, 2 HAVING count(*) > 1""",
)
def dq_duplicate_windows(spark: SparkSession, folder: str) -> DataFrame:
    # Raw events as a badly loaded summary table: most hours of a camera occur several times.
    rows = I.detections(spark, folder).select(
        "source_id", clock.window_start(F.col("ts"), I.HOUR).alias("window_start")
    )
    return aggregates.duplicate_windows(rows)


@query(
    "dq_speed_anomalies",
    f"""WITH {S.DET}, s AS (SELECT source_id, avg(speed_kmh * 3) AS avg_speed,
      min(speed_kmh * 3) AS min_speed, max(speed_kmh * 3) AS max_speed FROM det GROUP BY 1)
    SELECT source_id, {S.rnd("avg_speed", 6)} AS avg_speed, {S.rnd("min_speed", 6)} AS min_speed,
      {S.rnd("max_speed", 6)} AS max_speed, min_speed < 0 OR max_speed > 200 AS is_anomaly FROM s""",
)
def dq_speed_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    speeds = I.detections(spark, folder).select(
        "source_id", (F.col("speed_kmh") * 3).alias("avg_speed_kmh")
    )
    report = aggregates.speed_anomalies(speeds)
    return report.withColumns(
        {c: rounded(F.col(c), 6) for c in ("avg_speed", "min_speed", "max_speed")}
    )


_REPORTED = f"""{S.HOURLY}, once AS (SELECT window_start, source_id, avg_speed_kmh * 6 AS avg_speed_kmh FROM total),
  loaded AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE source_id IN ('cam_01', 'cam_03')),
  recent AS (SELECT * FROM loaded WHERE window_start >= {S.NOW} - INTERVAL 1 HOUR)"""


@query(
    "dq_quality_report",
    f"""WITH {_REPORTED}
    SELECT source_id, window_start, count(*) AS dup_count, CAST(NULL AS DOUBLE) AS max_speed,
      CAST(NULL AS BOOLEAN) AS is_anomaly FROM recent GROUP BY 1, 2 HAVING count(*) > 1
    UNION ALL SELECT source_id, NULL, NULL, {S.rnd("max(avg_speed_kmh)", 4)},
      min(avg_speed_kmh) < 0 OR max(avg_speed_kmh) > 200 FROM recent GROUP BY 1""",
)
def dq_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the last hour over a summary that was loaded twice for two cameras.

    The summary is written once; read from the events, each of its four uses would go over them again.
    """
    summary = written_out(I.hourly_totals(spark, folder), "totals")
    once = summary.select("window_start", "source_id", (F.col("avg_speed_kmh") * 6).alias("avg_speed_kmh"))
    loaded = once.unionByName(once.where(F.col("source_id").isin("cam_01", "cam_03")))
    duplicates, anomalies = aggregates.quality_report(loaded, I.AS_OF)
    speeds = anomalies.select("source_id", rounded(F.col("max_speed"), 4).alias("max_speed"), "is_anomaly")
    return duplicates.unionByName(speeds, allowMissingColumns=True).select(
        "source_id", "window_start", "dup_count", "max_speed", "is_anomaly"
    )


@query(
    "agg_network_summary",
    f"""WITH {S.SNAPSHOT} SELECT CAST(coalesce(sum(total_vehicles), 0) AS BIGINT) AS total_vehicles,
    coalesce({S.rnd("avg(avg_speed)", 1)}, 0) AS avg_speed,
    CAST(count_if(traffic_status <> 'LANCAR') AS BIGINT) AS incidents FROM snap""",
)
def agg_network_summary(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.network_summary(I.snapshot(spark, folder))


@query(
    "agg_history_points",
    f"""WITH {S.HOURLY} SELECT window_end AS recorded_at,
    CAST(sum(total_vehicles) AS BIGINT) AS vehicle_count,
    {S.rnd("coalesce(avg(avg_speed_kmh), 0)", 1)} AS speed_kmh, 0 AS incident_count
    FROM total GROUP BY 1""",
)
def agg_history_points(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.history_points(I.hourly_totals(spark, folder))


@query(
    "agg_camera_history",
    f"""WITH {S.HOURLY} SELECT window_end AS recorded_at, source_id,
    CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count FROM kinds GROUP BY 1, 2""",
)
def agg_camera_history(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.camera_history(I.hourly_by_type(spark, folder))


@query(
    "agg_detection_total",
    f"WITH {S.LOCATED} SELECT source_id, count(*) AS total_detections FROM loc GROUP BY 1",
)
def agg_detection_total(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.detection_total(I.located(spark, folder))
