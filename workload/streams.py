"""Streaming pipelines, run over files to their end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import clock
from roadpulse.functions.traffic import rounded
from roadpulse.operators import aggregates, filters
from roadpulse.plans.hourly import HourlyTables
from roadpulse.session import apply_runtime_options, new_folder
from roadpulse.sources import streams, tables
from roadpulse.streaming import hourly, live, tracks
from roadpulse.streaming.progress import ProgressTable
from workload import inputs as I
from workload import sql as S
from workload.registry import query
from workload.runs import append_stream, batch_stream, finish, stamp, write_files

_SPEEDS = ["avg_speed", "max_speed", "min_speed", "avg_confidence"]
_WINDOWS = S.LIVE_COLUMNS


def _measures(df: DataFrame) -> DataFrame:
    keys = ["source_id", "window_start", "window_end", "total_count"]
    return df.select(*keys, *[rounded(F.col(c), 6).alias(c) for c in _SPEEDS], "traffic_status")


def _message_files(
    spark: SparkSession, events: DataFrame, path: str | None = None, extra: DataFrame | None = None
) -> str:
    """Messages of all events, valid or not and some of them damaged, and whole messages of ``extra``.

    Each task of ``events`` makes the messages of its rows and writes them; see ``_dealt``.
    """
    path = path or new_folder(spark, "messages")
    sent = I.damaged(events)
    write_files(sent if extra is None else sent.unionByName(I.messages(extra).select("value")), path, None)
    return path


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return I.detections(spark, folder)


# Files of messages, where a stream takes a few of them per batch; more, on more cores, where it takes all.
FILES = 8


def _dealt(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """All events, dealt out to the tasks that shall write ``files`` files; None: as many as there are cores."""
    return I.detections(spark, folder, files or max(FILES, spark.sparkContext.defaultParallelism))


def _valid_one(events: DataFrame, year: int) -> DataFrame:
    """One valid event, moved to the first day of a year."""
    one = I.undamaged(filters.valid_batch(filters.valid_live(events))).limit(1)
    far = F.lit(f"{year}-01-01 00:00:00")
    return one.withColumns({"ts": far.cast("timestamp_ntz"), "timestamp": far})


def _shifted(events: DataFrame, days: int) -> DataFrame:
    """The same events at another time."""
    ts = (F.col("ts") + F.expr(f"interval {days} days")).alias("ts")
    moved = events.withColumn("ts", ts)
    return moved.withColumn("timestamp", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


@query(
    "stream_live",
    f"""WITH {S.ARRIVED}, {S.live_windows(5, "arrived")}, {S.newest("live", "latest")}
    SELECT {S.live_row()} FROM latest""",
)
def stream_live(spark: SparkSession, folder: str) -> DataFrame:
    """The pipeline as it is in production: windows of 5 seconds, approximate counts."""
    apply_runtime_options(spark)
    table, position = (new_folder(spark, n) for n in ("live", "position"))
    messages = streams.read_file_stream(spark, _message_files(spark, _dealt(spark, folder)))
    finish(
        live.start_live(
            messages,
            table,
            position,
            trigger={"availableNow": True},
            stamp=stamp(),
        )
    )
    return I.plain_live(tables.read_table(spark, table))


@query(
    "stream_watermark",
    f"WITH {S.STREAM_LIVE} SELECT {_WINDOWS} FROM live",
)
def stream_watermark(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs on one checkpoint: all events, a tick far ahead, late copies of all events.

    The tick moves the watermark, so the late copies are dropped as a whole. They lie a year
    back, in windows of their own, and would show up as extra rows.
    """
    path, position, table = (new_folder(spark, n) for n in ("messages", "position", "changes"))
    events = _dealt(spark, folder)
    tick = _valid_one(_events(spark, folder), 2030)
    for rows, extra in ((events, None), (events.limit(0), tick), (_shifted(events, -365), None)):
        _message_files(spark, rows, path, extra)
        messages = streams.read_file_stream(spark, path)
        windows = live.live_window_stream(messages, I.HOUR, exact=True)
        batch_stream(
            live.zoneless(windows), "update", live.BatchTableWriter(table), position
        )
    current = live.window_state(spark.read.parquet(table))
    return _measures(current.where(F.col("window_start") < "2026-01-01"))


@query(
    "stream_late_rows",
    f"""WITH {S.STREAM_LIVE}, n AS (SELECT count(*) AS n FROM det)
    SELECT 0 AS run, n AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM n
    UNION ALL SELECT 1, CAST(1 AS BIGINT), CAST(0 AS BIGINT)
    UNION ALL SELECT 2, n, (SELECT count(*) FROM live) FROM n""",
)
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read and windows dropped behind the watermark, as three runs on one checkpoint report them."""
    path, position, table = (new_folder(spark, n) for n in ("messages", "position", "changes"))
    events = _dealt(spark, folder)
    tick = _valid_one(_events(spark, folder), 2030)
    runs = ((events, None), (events.limit(0), tick), (_shifted(events, -365), None))
    number = {}
    with ProgressTable(spark) as progress:
        for rows, extra in runs:
            _message_files(spark, rows, path, extra)
            windows = live.live_window_stream(streams.read_file_stream(spark, path), I.HOUR, exact=True)
            ended = batch_stream(live.zoneless(windows), "update", live.BatchTableWriter(table), position)
            progress.wait(ended)
            number[str(ended.runId)] = len(number)
        found = progress.take()
    known = spark.createDataFrame(list(number.items()), "run_id string, run int")
    per_run = found.join(F.broadcast(known), "run_id").groupBy("run")
    return per_run.agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))


@query(
    "stream_filter_counts",
    f"""WITH {S.DECODED}, steps AS (SELECT *, source_id IS NOT NULL AND tracker_id IS NOT NULL
        AND vehicle_type IS NOT NULL AND speed_kmh IS NOT NULL AND "timestamp" IS NOT NULL AS complete FROM decoded)
    SELECT count(*) AS rows_read, CAST(count_if(complete) AS BIGINT) AS rows_complete,
      CAST(count_if(complete AND speed_kmh > 0 AND speed_kmh < 150 AND "timestamp" <> 'not-a-time') AS BIGINT) AS rows_kept
    FROM steps""",
)
def stream_filter_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after each filter of the hourly job, observed on a stream in several batches."""
    path, table = new_folder(spark, "messages"), new_folder(spark, "kept")
    decoded = streams.decode(streams.read_file_stream(spark, _message_files(spark, _dealt(spark, folder, FILES), path), files_per_trigger=3))
    timed = decoded.withColumn("event_time", clock.parse_local_time(F.col("timestamp")))
    kept, _ = aggregates.counted_filters(timed)
    with ProgressTable(spark) as progress:
        ended = batch_stream(kept, "append", live.BatchTableWriter(table), new_folder(spark, "position"))
        progress.wait(ended)
        found = progress.take()
    values = [F.get_json_object(F.col("observed")[f"hourly_{s}"], f"$.{s}").cast("bigint") for s in aggregates.STEPS]
    return found.agg(*[F.sum(v).alias(s) for v, s in zip(values, aggregates.STEPS)])


@query("stream_tumbling", f"WITH {S.STREAM_LIVE} SELECT {_WINDOWS} FROM live")
def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    """Append mode: a window comes out once, after the watermark has passed it."""
    path = _message_files(spark, _dealt(spark, folder), extra=_valid_one(_events(spark, folder), 2030))
    messages = streams.read_file_stream(spark, path)
    windows = live.live_window_stream(messages, I.HOUR, "1 hour", exact=True)
    return _measures(append_stream(live.zoneless(windows)))


@query("stream_update_mode", f"WITH {S.STREAM_LIVE} SELECT {_WINDOWS} FROM live")
def stream_update_mode(spark: SparkSession, folder: str) -> DataFrame:
    """Several batches; each emits the windows it changed, and the last value of each stands."""
    table = new_folder(spark, "changes")
    path = _message_files(spark, _dealt(spark, folder, FILES))
    messages = streams.read_file_stream(spark, path, files_per_trigger=3)
    # The files are not in time order, so no row may count as late.
    windows = live.live_window_stream(messages, I.HOUR, "40 days", exact=True)
    batch_stream(
        live.zoneless(windows), "update", live.BatchTableWriter(table), new_folder(spark, "position")
    )
    return _measures(live.window_state(spark.read.parquet(table)))


@query("stream_trigger", f"WITH {S.DECODED} SELECT {S.FLAT} FROM decoded")
def stream_trigger(spark: SparkSession, folder: str) -> DataFrame:
    """A periodic trigger with a durable position: stopped and started again between two loads,
    every message arrives once."""
    path, position, table = (new_folder(spark, n) for n in ("messages", "position", "table"))
    everything = I.damaged_messages(spark, folder, 4)
    second = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    for part in (everything.where(~second), everything.where(second)):
        write_files(part, path, None)
        stream = I.flat_nullable(streams.decode(streams.read_file_stream(spark, path)))
        running = (
            stream.writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", position)
            .trigger(processingTime="1 second")
            .start()
        )
        running.processAllAvailable()
        running.stop()
    return spark.read.parquet(table)


@query(
    "stream_foreach_batch",
    f"WITH {S.STREAM_LIVE}, {S.newest('live', 'latest')} SELECT {S.live_row()} FROM latest",
)
def stream_foreach_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch is delivered twice, as after a failure; an empty one is skipped."""
    table, position = new_folder(spark, "live"), new_folder(spark, "position")
    writer = live.SnapshotWriter(table, position, stamp=stamp())

    def deliver_twice(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        writer(batch, batch_id)
        writer(batch.limit(0), 1_000_000 + batch_id)

    path = _message_files(spark, _dealt(spark, folder, FILES))
    messages = streams.read_file_stream(spark, path, files_per_trigger=4)
    windows = live.live_window_stream(messages, I.HOUR, "40 days", exact=True)
    batch_stream(windows, "update", deliver_twice, position)
    return I.plain_live(tables.read_table(spark, table))


@query(
    "stream_rate_limit",
    f"""WITH {S.DECODED} SELECT source_id, count(*) AS messages, CAST(4 AS BIGINT) AS batches
    FROM decoded GROUP BY 1""",
)
def stream_rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    """Eight files at two per trigger: four batches, nothing left behind."""
    table = new_folder(spark, "counts")
    path = _message_files(spark, _dealt(spark, folder, FILES))
    decoded = streams.decode(streams.read_file_stream(spark, path, files_per_trigger=2))

    def count(batch: DataFrame, batch_id: int) -> None:
        counts = batch.groupBy("source_id").agg(F.count("*").alias("n"))
        counts.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    batch_stream(decoded, "append", count, new_folder(spark, "position"))
    counts = spark.read.parquet(table)
    batches = counts.agg(F.count_distinct("batch")).scalar().alias("batches")
    per_source = counts.groupBy("source_id").agg(F.sum("n").alias("messages"))
    return per_source.select("source_id", "messages", batches)


_SESSIONS = f"""marked AS (SELECT source_id, tracker_id, ts, speed_kmh,
    CASE WHEN ts <= lag(ts) OVER w + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS opens
    FROM det WHERE source_id IS NOT NULL AND speed_kmh IS NOT NULL
    WINDOW w AS (PARTITION BY source_id, tracker_id ORDER BY ts)),
  visits AS (SELECT *, sum(opens) OVER (PARTITION BY source_id, tracker_id ORDER BY ts
    ROWS UNBOUNDED PRECEDING) AS visit FROM marked)"""


def _known_points(spark: SparkSession, events: DataFrame, path: str) -> DataFrame:
    """Points of known cameras and speeds as a stream of files."""
    points = events.select("source_id", "tracker_id", "frame", "ts", "speed_kmh")
    write_files(points.withColumn("ts", clock.as_instant(F.col("ts"))), path, 4)
    stream = streams.read_file_stream(spark, path, spark.read.parquet(path).schema)
    return stream.where(F.col("source_id").isNotNull() & F.col("speed_kmh").isNotNull())


@query(
    "stream_track_state",
    f"""WITH {S.DET}, {_SESSIONS.replace("ts, speed_kmh", "ts, frame, speed_kmh", 1)}
    SELECT source_id, tracker_id, frame, ts AS seen, min(ts) OVER v AS visit_start, count(*) OVER v AS observations,
      {S.rnd("avg(speed_kmh) OVER v", 6)} AS avg_speed, false AS closed
    FROM visits WINDOW v AS (PARTITION BY source_id, tracker_id, visit ORDER BY ts, frame ROWS UNBOUNDED PRECEDING)
    UNION ALL SELECT source_id, tracker_id, NULL, max(ts) + INTERVAL 12 HOUR, min(ts), count(*),
      {S.rnd("avg(speed_kmh)", 6)}, true FROM visits GROUP BY source_id, tracker_id, visit""",
)
def stream_track_state(spark: SparkSession, folder: str) -> DataFrame:
    """Running state of every track over two runs; timers close the visits and empty the state."""
    apply_runtime_options(spark)
    path, position, table = (new_folder(spark, n) for n in ("points", "position", "table"))
    events = _events(spark, folder)
    early = F.col("ts") < F.lit(str(I.AS_OF)).cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early).unionByName(_valid_one(events, 2030))):
        stream = _known_points(spark, part, path)
        visits = append_stream(tracks.running_visits(stream, I.SESSION_GAP, "1 hour"), table, position)
    times = {c: clock.as_wall_clock(F.col(c)) for c in ("seen", "visit_start")}
    found = visits.withColumns({**times, "avg_speed": rounded(F.col("avg_speed"), 6)})
    return found.where(F.col("seen") < "2026-01-01")


@query(
    "stream_track_sessions",
    f"""WITH {S.DET}, {_SESSIONS}
    SELECT source_id, tracker_id, min(ts) AS session_start,
      max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS observations,
      {S.rnd("avg(speed_kmh)", 6)} AS avg_speed FROM visits GROUP BY source_id, tracker_id, visit""",
)
def stream_track_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """The same visits as session windows."""
    events = _events(spark, folder)
    known = _known_points(spark, events.unionByName(_valid_one(events, 2030)), new_folder(spark, "points"))
    visits = tracks.session_stream(known, I.SESSION_GAP, "1 hour")
    table = append_stream(live.zoneless(visits, "session_start", "session_end"))
    return table.withColumn("avg_speed", rounded(F.col("avg_speed"), 6))


@query(
    "stream_track_speed",
    f"""WITH {S.LOCATED}, {S.ENDPOINT} SELECT source_id, tracker_id, frame,
    points, {S.rnd("speed_kmh", 4)} AS speed_kmh,
    {S.rnd("mx", 4)} AS mx, {S.rnd("my", 4)} AS my FROM points""",
)
def stream_track_speed(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs split by time, so that the second continues from the state of the first."""
    apply_runtime_options(spark)
    path, position, table = (new_folder(spark, n) for n in ("points", "position", "table"))
    located = I.located(spark, folder)
    points = located.select("source_id", "tracker_id", "frame", "mx", "my", "fps", "ts")
    early = F.col("ts") < F.lit(str(I.AS_OF)).cast("timestamp_ntz")
    for rows in (points.where(early), points.where(~early)):
        write_files(rows.drop("ts"), path)
        stream = streams.read_file_stream(spark, path, rows.drop("ts").schema)
        finish(tracks.start_track_speed(stream, table, position, "fps"))
    speeds = spark.read.parquet(table)
    return speeds.select(
        "source_id",
        "tracker_id",
        "frame",
        "points",
        *[rounded(F.col(c), 4).alias(c) for c in ("speed_kmh", "mx", "my")],
    )


@query(
    "stream_hourly",
    f"""WITH {S.STREAM_HOURLY}
    SELECT window_start, window_end, source_id, 'all' AS vehicle_type, total_vehicles AS vehicle_count,
      avg_speed_kmh, CAST(NULL AS DOUBLE) AS avg_observations, {S.NOW} AS created_at FROM total
    UNION ALL SELECT window_start, window_end, source_id, vehicle_type, vehicle_count, avg_speed_kmh,
      avg_observations, {S.NOW} FROM kinds""",
)
def stream_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Both published tables; the totals as type 'all'."""
    apply_runtime_options(spark)
    totals, by_type, position = (new_folder(spark, n) for n in ("totals", "by_type", "position"))
    path = _message_files(spark, _dealt(spark, folder), extra=_valid_one(_events(spark, folder), 2030))
    messages = streams.read_file_stream(spark, path)
    finish(hourly.start_hourly(messages, HourlyTables(totals, by_type), position, stamp=stamp()))
    whole = tables.read_table(spark, totals).withColumnRenamed("total_vehicles", "vehicle_count")
    whole = whole.withColumns({"vehicle_type": F.lit("all"), "avg_observations": F.lit(None).cast("double")})
    return tables.read_table(spark, by_type).unionByName(whole)


@query("stream_hourly_totals", f"WITH {S.STREAM_HOURLY} SELECT * FROM total")
def stream_hourly_totals(spark: SparkSession, folder: str) -> DataFrame:
    path = _message_files(spark, _dealt(spark, folder), extra=_valid_one(_events(spark, folder), 2030))
    vehicles = hourly.vehicle_stream(streams.read_file_stream(spark, path))
    return append_stream(live.zoneless(hourly.total_stream(vehicles)))
