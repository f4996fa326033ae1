"""Building blocks of the check SQL."""

from __future__ import annotations

import numpy as np

from workload.inputs import AS_OF, CAMERAS, CLASSES, EARLIER, TYPES

NOW = f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}'"
BEFORE = f"TIMESTAMP '{EARLIER:%Y-%m-%d %H:%M:%S}'"


def rnd(value: str, digits: int) -> str:
    return f"round(({value}) + 1e-9, {digits})"


def _case(column: str, options: dict, default) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in options.items())
    return f"CASE {column} {whens} ELSE {default!r} END"


DET = f"""det AS (
  SELECT event_id,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE 'cam_0' || (user_id % 4 + 1) END AS source_id,
    CAST(user_id AS INTEGER) AS tracker_id,
    {_case("event_type", TYPES, "unknown")} AS vehicle_type,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 307 = 0 THEN 0.0::DOUBLE
         ELSE value * 0.4::DOUBLE END AS speed_kmh,
    CAST(event_id * 37 % 101 AS DOUBLE) / 100.0::DOUBLE AS confidence,
    ts,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS processing_time,
    CAST(event_id AS INTEGER) AS frame,
    CAST(event_id % 7 AS DOUBLE) AS pos_x, CAST(event_id % 23 AS DOUBLE) AS pos_y,
    CAST(event_id % 25 + 2 AS INTEGER) AS trajectory_length,
    CAST({_case("event_type", CLASSES, 0)} AS INTEGER) AS class_id,
    CAST(400 + event_id * 7919 % 1000 AS DOUBLE) AS px,
    CAST(150 + event_id * 104729 % 420 AS DOUBLE) AS py
  FROM events)"""

# Nullable integers are compared as doubles: the engines' table forms differ for them.
_NUMBERS = ["tracker_id", "frame", "trajectory_length"]

FLAT = (
    "source_id, tracker_id, vehicle_type, speed_kmh, confidence, \"timestamp\", processing_time, "
    "frame, pos_x, pos_y, trajectory_length"
)



def _decoded_columns() -> str:
    columns = []
    for name in (part.strip() for part in FLAT.split(",")):
        value = f"CAST({name} AS DOUBLE)" if name in _NUMBERS else name
        columns.append(f"CASE WHEN cut THEN NULL ELSE {value} END AS {name}")
    return ", ".join(columns)


_CUT = "event_id % 97 = 0"
_BAD_TIME = f"NOT ({_CUT}) AND event_id % 101 = 0"
_BAD_TRACKER = f"NOT ({_CUT}) AND event_id % 101 <> 0 AND event_id % 103 = 0"
DECODED = f"""{DET},
whole AS (SELECT event_id, {_CUT} AS cut,
  CASE WHEN {_BAD_TRACKER} THEN NULL ELSE tracker_id END AS tracker_id,
  CASE WHEN {_BAD_TIME} THEN 'not-a-time' ELSE "timestamp" END AS "timestamp",
  source_id, vehicle_type, speed_kmh, confidence, processing_time, frame, pos_x, pos_y,
  trajectory_length, ts FROM det),
decoded AS (SELECT cut, {_decoded_columns()}, ts FROM whole)"""

LIVE_VALID = (
    "source_id IS NOT NULL AND vehicle_type IS NOT NULL AND tracker_id IS NOT NULL "
    "AND speed_kmh >= 0 AND speed_kmh < 150 AND confidence > 0.3::DOUBLE"
)
BATCH_VALID = (
    "source_id IS NOT NULL AND vehicle_type IS NOT NULL AND tracker_id IS NOT NULL "
    'AND "timestamp" IS NOT NULL AND speed_kmh > 0 AND speed_kmh < 150'
)
STATUS = (
    "CASE WHEN total_count IS NULL OR total_count = 0 OR avg_speed IS NULL THEN 'SEPI' "
    "WHEN total_count <= 2 THEN 'LANCAR' WHEN avg_speed < 10 THEN 'MACET' "
    "WHEN avg_speed < 30 THEN 'PADAT' ELSE 'LANCAR' END"
)


def live_windows(seconds: int, rows: str = "det", name: str = "live") -> str:
    start = f"time_bucket(INTERVAL {seconds} SECOND, ts, TIMESTAMP '1970-01-01')"
    return f"""{name} AS (SELECT source_id, window_start,
  window_start + INTERVAL {seconds} SECOND AS window_end, total_count, avg_speed, max_speed,
  min_speed, avg_confidence, {STATUS} AS traffic_status
  FROM (SELECT source_id, {start} AS window_start, count(DISTINCT tracker_id) AS total_count,
    avg(speed_kmh) AS avg_speed, max(speed_kmh) AS max_speed, min(speed_kmh) AS min_speed,
    avg(confidence) AS avg_confidence
    FROM {rows} WHERE {LIVE_VALID} GROUP BY 1, 2))"""


LIVE = f"{DET}, {live_windows(3600)}"
# What is left of the damaged messages that streams are fed with.
ARRIVED = f"""{DECODED},
arrived AS (SELECT * FROM decoded WHERE "timestamp" <> 'not-a-time')"""
STREAM_LIVE = f"{ARRIVED}, {live_windows(3600, 'arrived')}"

LIVE_COLUMNS = f"""source_id, window_start, window_end, total_count,
  {rnd("avg_speed", 6)} AS avg_speed, {rnd("max_speed", 6)} AS max_speed,
  {rnd("min_speed", 6)} AS min_speed, {rnd("avg_confidence", 6)} AS avg_confidence,
  traffic_status"""


def live_row(stamp: str = NOW) -> str:
    return f"""source_id, window_start, window_end, CAST(total_count AS INTEGER) AS total_count,
  CAST(CAST({rnd("avg_speed", 2)} AS DECIMAL(6,2)) AS DOUBLE) AS avg_speed,
  CAST(CAST({rnd("max_speed", 2)} AS DECIMAL(6,2)) AS DOUBLE) AS max_speed,
  CAST(CAST({rnd("min_speed", 2)} AS DECIMAL(6,2)) AS DOUBLE) AS min_speed,
  CAST(CAST({rnd("avg_confidence", 3)} AS DECIMAL(4,3)) AS DOUBLE) AS avg_confidence, traffic_status,
  {stamp} AS created_at, {stamp} AS updated_at"""


def newest(rows: str, name: str, where: str = "true") -> str:
    return f"""{name} AS (SELECT * FROM {rows} WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY window_start DESC) = 1)"""


def _shown(rows: str, name: str) -> str:
    return f"""{name} AS (SELECT source_id, total_count AS total_vehicles,
  CAST(avg_speed AS DOUBLE) AS avg_speed, CAST(max_speed AS DOUBLE) AS max_speed, traffic_status,
  updated_at AS last_update FROM (SELECT {live_row()} FROM {rows}))"""


SNAPSHOT = f"{LIVE}, {newest('live', 'latest')}, {_shown('latest', 'snap')}"
SHOWN = f"{LIVE}, {_shown('live', 'snap')}"


def vehicles(rows: str = "det", prefix: str = "") -> str:
    return f"""{prefix}typed AS (SELECT date_trunc('hour', ts) AS window_start, source_id, tracker_id,
  vehicle_type, count(*) AS n, sum(speed_kmh) AS s, min(speed_kmh) AS lo, max(speed_kmh) AS hi
  FROM {rows} WHERE {BATCH_VALID} GROUP BY ALL),
{prefix}veh AS (SELECT window_start, source_id, tracker_id,
  arg_min(vehicle_type, (-n, vehicle_type)) AS vehicle_type, sum(s) / sum(n) AS avg_speed,
  CAST(sum(n) AS BIGINT) AS count_observations, min(lo) AS min_speed, max(hi) AS max_speed
  FROM {prefix}typed GROUP BY 1, 2, 3)"""


def totals(prefix: str = "") -> str:
    return f"""{prefix}total AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
  source_id, CAST(count(*) AS INTEGER) AS total_vehicles,
  {rnd("avg(avg_speed)", 2)} AS avg_speed_kmh FROM {prefix}veh GROUP BY 1, 2, 3)"""


def by_type(prefix: str = "") -> str:
    return f"""{prefix}kinds AS (SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end,
  source_id, vehicle_type, CAST(count(*) AS INTEGER) AS vehicle_count,
  {rnd("avg(avg_speed)", 2)} AS avg_speed_kmh,
  {rnd("avg(count_observations)", 2)} AS avg_observations FROM {prefix}veh GROUP BY 1, 2, 3, 4)"""


HOURLY = f"{DET}, {vehicles()}, {totals()}, {by_type()}"
STREAM_HOURLY = f"{ARRIVED}, {vehicles('arrived')}, {totals()}, {by_type()}"


def _solve(source: list, target: list) -> list[float]:
    """Projection coefficients by an 8x8 linear solve, independent of the closed form."""
    rows, right = [], []
    for (x, y), (u, v) in zip(source, target):
        rows += [[x, y, 1, 0, 0, 0, -u * x, -u * y], [0, 0, 0, x, y, 1, -v * x, -v * y]]
        right += [u, v]
    return [float(c) for c in np.linalg.solve(np.array(rows, float), np.array(right, float))]


def _camera_values() -> str:
    lines = []
    for camera in CAMERAS:
        w, h = camera["target_w"] - 1, camera["target_h"] - 1
        flat_target = [(0, 0), (w, 0), (w, h), (0, h)]
        numbers = [float(v) for p in camera["roi"] for v in p]
        numbers += _solve(camera["roi"], flat_target) + _solve(flat_target, camera["roi"])
        listed = ", ".join(f"{v!r}::DOUBLE" for v in numbers)
        rate = float(camera.get("fps", 25.0))
        lines.append(f"('{camera['source_id']}', {rate!r}::DOUBLE, {listed})")
    return ",\n  ".join(lines)


_NAMES = [f"{a}{i}" for i in range(4) for a in "xy"]
_NAMES += [f"h{i}" for i in range(8)] + [f"g{i}" for i in range(8)]
CAM = f"cam AS (SELECT * FROM (VALUES {_camera_values()}) v(source_id, fps, {', '.join(_NAMES)}))"


def _edge(a: int, b: int) -> str:
    return (
        f"CASE WHEN ((y{a} > py) <> (y{b} > py)) AND px < x{a} + (py - y{a}) * (x{b} - x{a}) "
        f"/ nullif(y{b} - y{a}, 0) THEN 1 ELSE 0 END"
    )


INSIDE = "(" + " + ".join(_edge(a, (a + 1) % 4) for a in range(4)) + ") % 2 = 1"
METRES = (
    "(h0 * px + h1 * py + h2) / (h6 * px + h7 * py + 1) AS mx, "
    "(h3 * px + h4 * py + h5) / (h6 * px + h7 * py + 1) AS my"
)
LOCATED = f"""{DET}, {CAM},
loc AS (SELECT det.* EXCLUDE (speed_kmh), fps, {METRES} FROM det JOIN cam USING (source_id)
  WHERE {INSIDE})"""

TRACK = "PARTITION BY source_id, tracker_id ORDER BY frame"
ENDPOINT = f"""points AS (SELECT *, count(*) OVER w AS points,
  sqrt((mx - first_value(mx) OVER w) ** 2 + (my - first_value(my) OVER w) ** 2)
    / (count(*) OVER w / fps) * 3.6::DOUBLE AS speed_kmh
  FROM loc WINDOW w AS ({TRACK} ROWS BETWEEN CAST(fps - 1 AS INTEGER) PRECEDING AND CURRENT ROW))"""
VISITED = f"""opened AS (SELECT *, CASE WHEN ts > lag(ts) OVER o + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS opens
  FROM loc WINDOW o AS ({TRACK})),
visited AS (SELECT *, sum(opens) OVER ({TRACK} ROWS UNBOUNDED PRECEDING) AS visit FROM opened)"""
VISIT = "PARTITION BY source_id, tracker_id, visit ORDER BY frame"
PATH = f"""{VISITED},
steps AS (SELECT *, sqrt((mx - lag(mx) OVER o) ** 2 + (my - lag(my) OVER o) ** 2) AS step
  FROM visited WINDOW o AS ({VISIT})),
paths AS (SELECT *, CASE WHEN points >= 3 THEN path / (points / fps) * 3.6::DOUBLE END
    AS path_speed_kmh
  FROM (SELECT *, sum(step) OVER (w ROWS BETWEEN 28 PRECEDING AND CURRENT ROW) AS path,
    count(*) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS points
    FROM steps WINDOW w AS ({VISIT})))"""

BOXES = f"""{DET},
boxes AS (SELECT event_id AS box_id, CAST(event_id // 8 AS INTEGER) AS frame, source_id,
  tracker_id, class_id, confidence,
  cx - w / 2 AS x1, cy - h / 2 AS y1, cx + w / 2 AS x2, cy + h / 2 AS y2
  FROM (SELECT *, CAST(600 + event_id * 31 % 40 AS DOUBLE) AS cx,
    CAST(300 + event_id * 17 % 30 AS DOUBLE) AS cy, CAST(120 + event_id % 30 AS DOUBLE) AS w,
    CAST(90 + event_id % 20 AS DOUBLE) AS h FROM det))"""
