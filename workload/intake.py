"""Sources, sinks and table contracts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions import clock
from roadpulse.operators import aggregates
from roadpulse.plans import hourly
from roadpulse.schema import LIVE_KEY, SUMMARY_KEY, TYPE_KEY, contract_violations
from roadpulse.session import new_folder
from roadpulse.sources import record_log, streams, tables
from workload import inputs as I
from workload import sql as S
from workload.registry import query
from workload.runs import append_stream, finish

DECODED = f"WITH {S.DECODED} SELECT {S.FLAT} FROM decoded"


@query("src_detection_stream", DECODED)
def detection_stream(spark: SparkSession, folder: str) -> DataFrame:
    source = new_folder(spark, "messages")
    I.damaged_messages(spark, folder, 8).write.parquet(source)
    stream = streams.read_file_stream(spark, source, files_per_trigger=4)
    return append_stream(I.flat_nullable(streams.decode(stream)))


@query("src_incremental_batch", DECODED)
def incremental_batch(spark: SparkSession, folder: str) -> DataFrame:
    source, table, checkpoint = (new_folder(spark, n) for n in ("messages", "table", "position"))
    everything = I.damaged_messages(spark, folder, 4)
    # Two runs: the second one starts where the first one stopped.
    late = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    for part in (everything.where(~late), everything.where(late)):
        part.write.mode("append").parquet(source)
        stream = streams.read_file_stream(spark, source, files_per_trigger=2)
        append_stream(I.flat_nullable(streams.decode(stream)), table, checkpoint)
    return spark.read.parquet(table)


def _log(spark: SparkSession, messages: DataFrame, path: str) -> None:
    """Messages as one more segment, dealt by their text."""
    record_log.append_log(messages.select("value"), path, F.col("value"), 4)


def _counted_batches(stream: DataFrame, table: str, position: str) -> None:
    """Drain a stream of a log into a folder per batch."""
    record_log.drained(record_log.start_batches(stream, table, position))


@query("src_record_log", f"WITH {S.DECODED} SELECT {S.FLAT}, true AS bounded, true AS whole FROM decoded")
def src_record_log(spark: SparkSession, folder: str) -> DataFrame:
    """At most 3,000 records a trigger, as measured in the batches; the offsets of a partition have no gaps."""
    path, table, position = (new_folder(spark, n) for n in ("log", "table", "position"))
    _log(spark, I.damaged_messages(spark, folder, max(8, spark.sparkContext.defaultParallelism)), path)
    _counted_batches(record_log.read_log_stream(spark, path, C.LIVE_RECORDS_PER_TRIGGER), table, position)
    read = spark.read.parquet(table)
    bounded = read.groupBy("batch").count().agg(F.max("count") <= C.LIVE_RECORDS_PER_TRIGGER).scalar()
    gaps = read.groupBy("partition").agg((F.max("offset") + 1 == F.count_distinct("offset")).alias("w"), F.count("*").alias("n"), F.max("offset").alias("m"))
    whole = gaps.agg(F.bool_and(F.col("w") & (F.col("n") == F.col("m") + 1))).scalar()
    return I.flat_nullable(streams.decode(read)).withColumns({"bounded": bounded, "whole": whole})


@query(
    "src_log_backlog",
    f"WITH {S.DECODED} SELECT {S.FLAT} FROM decoded",
)
def src_log_backlog(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs, each up to the end that the log had at its start, in batches of a tenth of the log."""
    path, table, position = (new_folder(spark, n) for n in ("log", "table", "position"))
    everything = I.damaged_messages(spark, folder)
    late = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    _log(spark, everything.where(~late), path)
    ends = record_log.log_ends(path)
    cap = -(-sum(ends.values()) // 5)
    # The second half arrives while the first run is under way; it waits for the second run.
    _log(spark, everything.where(late), path)
    _counted_batches(record_log.read_log_stream(spark, path, cap, ends), table, position)
    if spark.read.parquet(table).count() != sum(ends.values()):
        raise AssertionError("the first run did not stop at its end")
    _counted_batches(record_log.read_log_stream(spark, path, cap, record_log.log_ends(path)), table, position)
    return I.flat_nullable(streams.decode(spark.read.parquet(table).select("value")))


@query("sink_jsonl_stream", DECODED)
def sink_jsonl_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded messages as JSON lines, in two runs of several batches; each record is there once."""
    source, path, position = (new_folder(spark, n) for n in ("messages", "jsonl", "position"))
    everything = I.damaged_messages(spark, folder, 4)
    late = F.pmod(F.xxhash64("value"), F.lit(2)) == 1
    for part in (everything.where(~late), everything.where(late)):
        part.write.mode("append").parquet(source)
        stream = streams.decode(streams.read_file_stream(spark, source, files_per_trigger=2))
        finish(tables.start_jsonl(stream, path, position))
    return I.flat_nullable(tables.read_jsonl(spark, path))


@query("decode_events", DECODED)
def decode_events(spark: SparkSession, folder: str) -> DataFrame:
    return I.flat_nullable(streams.decode(I.damaged_messages(spark, folder)))


@query("decode_events_checked", f"WITH {S.DECODED} SELECT {S.FLAT} FROM decoded WHERE NOT cut")
def decode_events_checked(spark: SparkSession, folder: str) -> DataFrame:
    good, _ = streams.decode_checked(I.damaged_messages(spark, folder))
    return I.flat_nullable(good)


@query(
    "decode_quarantine",
    f"""WITH {S.DECODED} SELECT 'source_id,tracker_id,vehicle_type,speed_kmh,timestamp' AS missing,
    count(*) AS messages, CAST(20 AS BIGINT) AS characters FROM decoded WHERE cut""",
)
def decode_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """What the checked decoding sets aside, by what it lacks, and how long the texts are at most."""
    _, aside = streams.decode_checked(I.damaged_messages(spark, folder))
    return aside.groupBy(F.array_join("missing", ",").alias("missing")).agg(
        F.count("*").alias("messages"), F.max(F.length("value")).cast("bigint").alias("characters")
    )


@query(
    "set_missing_columns",
    f"""WITH {S.DECODED}, n AS (SELECT count_if(NOT cut) AS messages FROM decoded)
    SELECT unnest(['source_id', 'tracker_id', 'vehicle_type', 'speed_kmh', 'timestamp'])
      AS column_name, CAST(messages AS BIGINT) AS messages, messages = 0 AS is_missing FROM n""",
)
def set_missing_columns(spark: SparkSession, folder: str) -> DataFrame:
    return streams.field_coverage(I.damaged_messages(spark, folder))


@query("sink_jsonl", f"WITH {S.DET} SELECT {S.FLAT} FROM det")
def sink_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "jsonl")
    tables.write_jsonl(I.detections(spark, folder).select(*I.EVENT_COLUMNS), path)
    return I.flat(tables.read_jsonl(spark, path))


@query("sink_topic", f"WITH {S.DET} SELECT source_id AS key, {S.FLAT} FROM det")
def sink_topic(spark: SparkSession, folder: str) -> DataFrame:
    records = streams.topic_records(I.detections(spark, folder).select(*I.EVENT_COLUMNS))
    data = F.from_json("value", streams.EVENT_SCHEMA).alias("data")
    decoded = records.select("key", data).select("key", "data.*")
    return decoded.select("key", *[F.col(c) for c in I.EVENT_COLUMNS]).select(
        "key",
        *[c for c in I.EVENT_COLUMNS if c != "position_meters"],
        F.col("position_meters.x").alias("pos_x"),
        F.col("position_meters.y").alias("pos_y"),
    )


def _merged_live() -> str:
    changed = [
        "window_start", "window_end", "total_count", "avg_speed", "max_speed", "min_speed",
        "avg_confidence", "traffic_status", "updated_at",
    ]
    listed = ", ".join(
        f"CASE WHEN i.source_id IS NOT NULL THEN i.{c} ELSE s.{c} END AS {c}" for c in changed
    )
    return f"""WITH {S.LIVE},
    {S.newest("live", "first_rows", f"window_start < {S.NOW}")},
    {S.newest("live", "second_rows", f"window_start >= {S.NOW}")},
    s AS (SELECT {S.live_row(S.BEFORE)} FROM first_rows),
    i AS (SELECT {S.live_row(S.NOW)} FROM second_rows)
    SELECT coalesce(s.source_id, i.source_id) AS source_id,
      coalesce(s.created_at, i.created_at) AS created_at, {listed}
    FROM s FULL JOIN i ON s.source_id = i.source_id"""


@query("sink_live_upsert", _merged_live())
def sink_live_upsert(spark: SparkSession, folder: str) -> DataFrame:
    table = new_folder(spark, "live")
    windows = I.live_hours(spark, folder)
    old = windows.where(F.col("window_start") < clock.ntz(I.AS_OF))
    new = windows.where(F.col("window_start") >= clock.ntz(I.AS_OF))
    # The third batch repeats the first: old windows must not replace newer ones.
    batches = [(old, I.EARLIER), (new, I.AS_OF), (old, I.EARLIER)]
    for number, (rows, stamp) in enumerate(batches):
        newest = I.live_rows(aggregates.latest_per_source(rows), stamp)
        tables.upsert_table(newest, table, "query", number, LIVE_KEY, newest="window_start")
    return I.plain_live(tables.read_table(spark, table))


@query(
    "sink_staging_overwrite",
    f"WITH {S.LIVE}, {S.newest('live', 'latest')} SELECT {S.live_row()} FROM latest",
)
def sink_staging_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "staging")
    windows = I.live_hours(spark, folder)
    tables.write_staging(I.live_rows(windows), path)
    newest = I.live_rows(aggregates.latest_per_source(windows))
    return I.plain_live(tables.write_staging(newest, path))


# The split lies within an hour, so both runs hold a part of that hour; the second part wins.
SPLIT = I.AS_OF + timedelta(minutes=30)
_SPLIT = f"TIMESTAMP '{SPLIT:%Y-%m-%d %H:%M:%S}'"


def _merged_hourly(rows: str, keys: list[str], columns: list[str]) -> str:
    parts = ", ".join(
        f"{p}rows AS (SELECT * FROM det WHERE ts {op} {_SPLIT}), {S.vehicles(p + 'rows', p)}, "
        f"{S.totals(p)}, {S.by_type(p)}"
        for p, op in (("a_", "<"), ("b_", ">="))
    )
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    values = ", ".join(f"coalesce(b.{c}, a.{c}) AS {c}" for c in [*keys, *columns])
    return f"""WITH {S.DET}, {parts}
    SELECT {values}, CASE WHEN a.source_id IS NOT NULL THEN {S.BEFORE} ELSE {S.NOW} END AS created_at
    FROM a_{rows} a FULL JOIN b_{rows} b ON {on}"""


def _publish(spark: SparkSession, folder: str, summary, keys: list[str]) -> DataFrame:
    table = new_folder(spark, "summary")
    events = I.detections(spark, folder)
    for number, (when, stamp) in enumerate(
        [(F.col("ts") < clock.ntz(SPLIT), I.EARLIER), (F.col("ts") >= clock.ntz(SPLIT), I.AS_OF)]
    ):
        rows = summary(events.where(when)).withColumn("created_at", clock.ntz(stamp))
        tables.upsert_table(rows, table, "query", number, keys, day_of="window_start")
    return tables.read_table(spark, table)


@query(
    "sink_summary_upsert",
    _merged_hourly("total", SUMMARY_KEY, ["window_end", "total_vehicles", "avg_speed_kmh"]),
)
def sink_summary_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return _publish(spark, folder, hourly.totals, SUMMARY_KEY)


@query(
    "sink_type_upsert",
    _merged_hourly(
        "kinds", TYPE_KEY, ["window_end", "vehicle_count", "avg_speed_kmh", "avg_observations"]
    ),
)
def sink_type_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return _publish(spark, folder, hourly.by_type, TYPE_KEY)


@query(
    "src_table_scan",
    """SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
)
def src_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    return tables.scan_range(
        I.table(spark, folder, "events"),
        ["event_id", "ts", "user_id", "event_type", "value"],
        "ts",
        *clock.local_day_bounds(I.AS_OF),
        order=["ts", "event_id"],
    )


@query(
    "table_contract",
    f"""WITH {S.DET},
    checks AS (
      SELECT 'not_null' AS "check", 'source_id' AS column_name,
        count_if(source_id IS NULL) AS violations FROM det
      UNION ALL SELECT 'not_null', 'tracker_id', count_if(tracker_id IS NULL) FROM det
      UNION ALL SELECT 'not_null', 'speed_kmh', count_if(speed_kmh IS NULL) FROM det
      UNION ALL SELECT 'max_length', 'source_id', count_if(length(source_id) > 20) FROM det
      UNION ALL SELECT 'max_length', 'vehicle_type', count_if(length(vehicle_type) > 5) FROM det
      UNION ALL SELECT 'unique', 'source_id,vehicle_type,timestamp',
        coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM det
          GROUP BY source_id, vehicle_type, "timestamp"))
    SELECT "check", column_name, CAST(violations AS BIGINT) AS violations FROM checks""",
)
def table_contract(spark: SparkSession, folder: str) -> DataFrame:
    return contract_violations(
        I.detections(spark, folder),
        not_null=["source_id", "tracker_id", "speed_kmh"],
        max_length={"source_id": 20, "vehicle_type": 5},
        key=["source_id", "vehicle_type", "timestamp"],
    )


