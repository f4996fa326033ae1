"""Joins, reshaping, rankings and set operations behind the dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import clock
from roadpulse.functions.traffic import rounded
from roadpulse.operators import aggregates, joins, projections, serving
from workload import inputs as I
from workload import sql as S
from workload.registry import query

TYPE_LIST = [*I.TYPES.values(), "unknown"]


@query(
    "join_camera_config",
    f"""WITH {S.DET}, {S.CAM} SELECT event_id, source_id, px, py, x0, y0,
    CAST(CASE source_id WHEN 'cam_01' THEN 6 WHEN 'cam_02' THEN 14 WHEN 'cam_03' THEN 5 ELSE 30 END
      AS DOUBLE) AS target_w FROM det JOIN cam USING (source_id)""",
)
def join_camera_config(spark: SparkSession, folder: str) -> DataFrame:
    joined = joins.with_camera(I.raw_detections(spark, folder), I.cameras(spark))
    return joined.select(
        "event_id",
        "source_id",
        "px",
        "py",
        F.col("roi")[0]["x"].alias("x0"),
        F.col("roi")[0]["y"].alias("y0"),
        "target_w",
    )


@query(
    "join_upsert_merge",
    f"""WITH {S.HOURLY},
    s AS (SELECT * FROM total WHERE window_start < {S.NOW} + INTERVAL 1 DAY),
    i AS (SELECT window_start, window_end, source_id, total_vehicles + 1 AS total_vehicles,
      avg_speed_kmh FROM total WHERE window_start >= {S.NOW})
    SELECT coalesce(s.window_start, i.window_start) AS window_start,
      coalesce(s.source_id, i.source_id) AS source_id,
      coalesce(i.window_end, s.window_end) AS window_end,
      coalesce(i.total_vehicles, s.total_vehicles) AS total_vehicles,
      coalesce(i.avg_speed_kmh, s.avg_speed_kmh) AS avg_speed_kmh,
      CASE WHEN s.source_id IS NOT NULL THEN {S.BEFORE} ELSE {S.NOW} END AS created_at
    FROM s FULL JOIN i ON s.window_start = i.window_start AND s.source_id = i.source_id""",
)
def join_upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    summary = I.hourly_totals(spark, folder)
    noon = clock.ntz(I.AS_OF)
    stored = summary.where(F.col("window_start") < noon + F.expr("interval 1 day"))
    incoming = summary.where(F.col("window_start") >= noon).withColumn(
        "total_vehicles", F.col("total_vehicles") + 1
    )
    return joins.upsert_rows(
        stored.withColumn("created_at", clock.ntz(I.EARLIER)),
        incoming.withColumn("created_at", noon),
        ["window_start", "source_id"],
    )


def _pivot(cameras: list[str]) -> str:
    return ", ".join(
        f"CAST(coalesce(sum(vehicle_count) FILTER (WHERE source_id = '{c}'), 0) AS BIGINT) AS {c}"
        for c in cameras
    )


@query(
    "pivot_camera_history",
    f"""WITH {S.HOURLY} SELECT window_end AS recorded_at, {_pivot(I.ROSTER)} FROM kinds GROUP BY 1""",
)
def pivot_camera_history(spark: SparkSession, folder: str) -> DataFrame:
    history = aggregates.camera_history(I.hourly_by_type(spark, folder))
    return serving.pivot_cameras(history, I.ROSTER)


@query(
    "densify_type_timeline",
    f"""WITH {S.HOURLY},
    grid AS (SELECT * FROM (SELECT DISTINCT source_id, window_end FROM kinds)
      JOIN (SELECT DISTINCT source_id, vehicle_type FROM kinds) USING (source_id)),
    dense AS (SELECT g.source_id, g.window_end AS recorded_at, g.vehicle_type,
      coalesce(CAST(k.vehicle_count AS DOUBLE), 0) AS c, coalesce(k.avg_speed_kmh, 0) AS s
      FROM grid g LEFT JOIN kinds k ON k.source_id = g.source_id AND k.window_end = g.window_end
        AND k.vehicle_type = g.vehicle_type)
    SELECT source_id, recorded_at, vehicle_type, 'count' AS metric, c AS value FROM dense
    UNION ALL SELECT source_id, recorded_at, vehicle_type, 'speed', s FROM dense""",
)
def densify_type_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return serving.type_timeline(I.hourly_by_type(spark, folder))


def _pivot_types() -> str:
    cells = []
    for t in TYPE_LIST:
        own = f"FILTER (WHERE vehicle_type = '{t}')"
        cells.append(f"CAST(coalesce(sum(vehicle_count) {own}, 0) AS BIGINT) AS {t}_count")
        cells.append(f"coalesce(max(avg_speed_kmh) {own}, 0) AS {t}_speed")
    return ", ".join(cells)


@query(
    "pivot_type_timeline",
    f"""WITH {S.HOURLY} SELECT window_end AS recorded_at, {_pivot_types()} FROM kinds
    WHERE source_id = 'cam_01' GROUP BY 1""",
)
def pivot_type_timeline(spark: SparkSession, folder: str) -> DataFrame:
    return serving.pivot_types(I.hourly_by_type(spark, folder), "cam_01", TYPE_LIST)


@query(
    "join_roster_default",
    f"""WITH {S.SNAPSHOT}, roster AS (SELECT unnest({I.ROSTER!r}) AS source_id)
    SELECT source_id, coalesce(total_vehicles, 0) AS total_vehicles,
      coalesce(avg_speed, 0) AS avg_speed, coalesce(max_speed, 0) AS max_speed,
      coalesce(traffic_status, 'MENUNGGU') AS traffic_status, last_update
    FROM roster LEFT JOIN (SELECT source_id, CAST(total_vehicles AS INTEGER) AS total_vehicles,
      avg_speed, max_speed, traffic_status, last_update FROM snap) USING (source_id)""",
)
def join_roster_default(spark: SparkSession, folder: str) -> DataFrame:
    return joins.roster_default(I.snapshot(spark, folder), I.cameras(spark))


@query(
    "diff_snapshot",
    f"""WITH {S.LIVE},
    {S.newest("live", "old_rows", f"window_start < {S.NOW}")}, {S.newest("live", "new_rows")},
    o AS (SELECT {S.live_row()} FROM old_rows), n AS (SELECT {S.live_row()} FROM new_rows)
    SELECT coalesce(o.source_id, n.source_id) AS source_id,
      o.total_count IS DISTINCT FROM n.total_count OR o.avg_speed IS DISTINCT FROM n.avg_speed
      OR o.max_speed IS DISTINCT FROM n.max_speed
      OR o.traffic_status IS DISTINCT FROM n.traffic_status
      OR o.updated_at IS DISTINCT FROM n.updated_at AS changed
    FROM o FULL JOIN n ON o.source_id = n.source_id""",
)
def diff_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    windows = I.live_hours(spark, folder)
    before = windows.where(F.col("window_start") < clock.ntz(I.AS_OF))
    old, new = (
        projections.snapshot_view(I.live_rows(aggregates.latest_per_source(rows)))
        for rows in (before, windows)
    )
    return joins.snapshot_changes(old, new)


@query(
    "win_latest_by_type",
    f"""WITH {S.HOURLY} SELECT source_id, vehicle_type, window_end, vehicle_count, avg_speed_kmh
    FROM kinds QUALIFY row_number() OVER
      (PARTITION BY source_id, vehicle_type ORDER BY window_end DESC) = 1""",
)
def win_latest_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return serving.latest_by_type(I.hourly_by_type(spark, folder))


@query(
    "topk_alerts",
    f"""WITH {S.SNAPSHOT},
    top AS (SELECT * FROM snap WHERE traffic_status <> 'LANCAR' ORDER BY source_id LIMIT 3)
    SELECT source_id || ' ' || lower(traffic_status) AS title,
      strftime(last_update, '%H:%M') AS time,
      CASE traffic_status WHEN 'MACET' THEN 'Tinggi' ELSE 'Sedang' END AS severity FROM top
    UNION ALL SELECT 'Belum ada data realtime', 'Menunggu sinkronisasi', 'Info'
    WHERE NOT EXISTS (SELECT 1 FROM snap)""",
)
def topk_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return serving.top_alerts(spark, I.snapshot(spark, folder))


@query(
    "topk_cameras",
    f"""WITH {S.SNAPSHOT} SELECT source_id AS name, CAST(least(100, greatest(25,
      floor(100 - avg_speed * 2 + total_vehicles / 2.0::DOUBLE + 0.5))) AS INTEGER) AS load,
      traffic_status AS status FROM snap ORDER BY source_id LIMIT 3""",
)
def topk_cameras(spark: SparkSession, folder: str) -> DataFrame:
    return serving.route_cards(I.snapshot(spark, folder))


@query(
    "tail_intervals",
    f"""WITH {S.HOURLY}, h AS (SELECT window_end AS recorded_at, source_id,
      CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count FROM kinds GROUP BY 1, 2)
    SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY recorded_at DESC) <= 24""",
)
def tail_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return serving.tail_intervals(aggregates.camera_history(I.hourly_by_type(spark, folder)))


@query(
    "sort_serving",
    f"""WITH {S.HOURLY} SELECT window_end, source_id, vehicle_type, vehicle_count,
    {S.rnd("avg_speed_kmh", 1)} AS avg_speed_kmh, window_end AS recorded_at FROM kinds""",
)
def sort_serving(spark: SparkSession, folder: str) -> DataFrame:
    by_type = projections.by_type_view(I.hourly_by_type(spark, folder))
    snapshot, summary = I.snapshot(spark, folder), I.hourly_totals(spark, folder)
    tables = serving.dashboard_payload(
        aggregates.network_summary(snapshot), snapshot, aggregates.history_points(summary), by_type
    )
    return tables["byType"]


@query(
    "set_union_timestamps",
    f"""WITH {S.HOURLY} SELECT DISTINCT window_end AS recorded_at FROM kinds
    WHERE source_id IN ('cam_01', 'cam_02')""",
)
def set_union_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return serving.union_times(I.hourly_by_type(spark, folder), ["cam_01", "cam_02"])


@query(
    "set_distinct_timestamps",
    f"WITH {S.HOURLY} SELECT DISTINCT window_end AS recorded_at FROM kinds WHERE source_id = 'cam_01'",
)
def set_distinct_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    return serving.camera_times(I.hourly_by_type(spark, folder), "cam_01")


@query(
    "camera_cards",
    f"""WITH {S.SNAPSHOT} SELECT source_id, CAST(total_vehicles AS INTEGER) AS total_vehicles,
      {S.rnd("avg_speed", 0)} AS avg_speed, traffic_status,
      CASE source_id WHEN 'cam_01' THEN 'Kamera 1' WHEN 'cam_02' THEN 'Kamera 2' ELSE source_id END
        AS label,
      CASE source_id WHEN 'cam_01' THEN 'Simpang Ciawi' ELSE 'Depan Balaikota Bogor' END AS place
    FROM snap ORDER BY source_id LIMIT 2""",
)
def camera_cards(spark: SparkSession, folder: str) -> DataFrame:
    cards = serving.camera_cards(I.snapshot(spark, folder))
    speed = rounded(F.col("avg_speed"), 0).alias("avg_speed")
    return cards.select("source_id", "total_vehicles", speed, "traffic_status", "label", "place")
