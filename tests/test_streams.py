"""Streams: equal to batch, late rows, restarts, state."""

import pathlib
import time
from datetime import datetime, timedelta

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadpulse.operators import aggregates, filters, windows
from roadpulse.plans import hourly as batch_hourly
from roadpulse.plans.hourly import HourlyTables
from roadpulse.session import new_folder
from roadpulse.sources import streams, tables
from roadpulse.streaming import hourly, live, tracks
from workload import inputs as I
from workload import runs
from workload import streams as queries
from workload.runs import batch_stream, finish, stamp, with_sentinel, write_files


def send(spark, path, rows):
    """Add events (time, camera, tracker, speed) to a message folder."""
    df = spark.createDataFrame(
        [(s, n, "car", float(k), 0.9, t.strftime("%Y-%m-%d %H:%M:%S")) for t, s, n, k in rows],
        "source_id string, tracker_id int, vehicle_type string, speed_kmh double, confidence double, timestamp string",
    )
    df.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("append").parquet(path)


T0 = datetime(2024, 1, 1, 12, 0, 0)


def run_live(spark, path, folder, **more):
    messages = streams.read_file_stream(spark, path)
    finish(
        live.start_live(
            messages, f"{folder}/live", f"{folder}/position",
            trigger={"availableNow": True}, **more,
        )
    )
    return {r.source_id: r for r in tables.read_table(spark, f"{folder}/live").collect()}


def test_live_snapshot_over_restarts(spark):
    path, folder = new_folder(spark, "in"), new_folder(spark, "out")
    send(spark, path, [(T0, "a", n, 5) for n in (1, 2, 3)] + [(T0, "b", 1, 50)])
    first = run_live(spark, path, folder)
    assert (first["a"].traffic_status, first["a"].total_count, str(first["a"].avg_speed)) == ("MACET", 3, "5.00")
    # Same window again, one camera only: the counts add up and the other camera stays.
    time.sleep(1.1)
    send(spark, path, [(T0 + timedelta(seconds=1), "a", 4, 45)])
    second = run_live(spark, path, folder)
    assert (second["a"].total_count, str(second["a"].avg_speed)) == (4, "15.00")
    assert second["a"].created_at == first["a"].created_at < second["a"].updated_at
    assert second["b"] == first["b"]
    # A newer window replaces the row; nothing new changes nothing.
    send(spark, path, [(T0 + timedelta(seconds=60), "a", 9, 70)])
    third = run_live(spark, path, folder)
    assert (third["a"].window_start, third["a"].total_count) == (T0 + timedelta(seconds=60), 1)
    assert run_live(spark, path, folder) == third
    # Far too late rows are dropped.
    send(spark, path, [(T0 - timedelta(hours=1), "a", 9, 1), (T0 - timedelta(hours=1), "c", 9, 1)])
    assert run_live(spark, path, folder) == third


def test_malformed_messages_do_not_stop_the_stream(spark):
    path, folder = new_folder(spark, "in"), new_folder(spark, "out")
    send(spark, path, [(T0, "a", 1, 5)])
    bad = [("{",), ("",), (None,), ('{"source_id":"a","timestamp":"x"}',)]
    spark.createDataFrame(bad, "value string").write.mode("append").parquet(path)
    assert set(run_live(spark, path, folder)) == {"a"}


def test_late_rows_are_dropped_after_the_watermark_moved(spark):
    path, position, out = (new_folder(spark, n) for n in ("in", "position", "out"))
    day = [(T0 + timedelta(minutes=m), "a", m, 10) for m in range(60)]
    late = [(T0 - timedelta(days=10), "a", 1, 10)]
    for rows in (day, [day[-1]], late):
        send(spark, path, rows)
        stream = live.live_window_stream(streams.read_file_stream(spark, path), "1 minute")
        batch_stream(live.zoneless(stream), "update", live.BatchTableWriter(out), position)
    assert live.window_state(spark.read.parquet(out)).count() == 60


def test_hourly_stream_equals_batch_and_joins_split_hours(spark, small):
    folder, path = new_folder(spark, "out"), new_folder(spark, "in")
    out = HourlyTables(f"{folder}/totals", f"{folder}/types")
    events = I.detections(spark, small)
    # The split lies within an hour; both parts of that hour must count.
    split = F.lit("2024-01-15 12:30:00").cast("timestamp_ntz")
    for part in (events.where(F.col("ts") < split), with_sentinel(events.where(F.col("ts") >= split))):
        write_files(I.messages(part).select("value"), path, 3)
        messages = streams.read_file_stream(spark, path)
        finish(hourly.start_hourly(messages, out, f"{folder}/position", "1 hour", stamp()))
    whole = batch_hourly.by_type(events)
    got = tables.read_table(spark, out.by_type).drop("created_at")
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))
    totals = batch_hourly.totals(events)
    got = tables.read_table(spark, out.totals).drop("created_at")
    assert sorted(map(str, got.select(*totals.columns).collect())) == sorted(map(str, totals.collect()))


def test_hourly_batch_run_is_repeatable(spark, small):
    folder = new_folder(spark, "out")
    out = HourlyTables(f"{folder}/totals", f"{folder}/types")
    events = I.detections(spark, small)
    for run_id in ("r1", "r1", "r2"):
        duplicates, anomalies = batch_hourly.run(events, out, run_id, I.AS_OF, stamp())
    assert duplicates.isEmpty() and anomalies.where("is_anomaly").isEmpty()
    got = tables.read_table(spark, out.totals).drop("created_at")
    want = batch_hourly.totals(events)
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_track_speed_state_continues_over_triggers(spark):
    path, out, position = (new_folder(spark, n) for n in ("in", "out", "position"))
    schema = "source_id string, tracker_id int, frame int, mx double, my double"
    rows = [("a", t, f, f * 0.5 * t, float(f % 3)) for t in (1, 2) for f in range(20)]
    for part in (rows[:7] + rows[20:31], rows[7:20], rows[31:]):
        spark.createDataFrame(part, schema).repartition(2).write.mode("append").parquet(path)
        stream = streams.read_file_stream(spark, path, spark.read.parquet(path).schema)
        finish(tracks.start_track_speed(stream, out, position, 5.0))
    want = windows.endpoint_speed(spark.createDataFrame(rows, schema), 5.0).collect()
    got = {(r.tracker_id, r.frame): r for r in spark.read.parquet(out).collect()}
    assert len(got) == len(want) == 40
    for r in want:
        state = got[(r.tracker_id, r.frame)]
        assert (state.points, state.speed_kmh) == pytest.approx((r.points, r.speed_kmh))


def speed_run(spark, path, out, position, rows, **more):
    """One run over added points; (batch's state operator, all speeds so far)."""
    schema = "source_id string, tracker_id int, frame int, mx double, my double"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    query = tracks.start_track_speed(streams.read_file_stream(spark, path, schema), out, position, 5.0, **more)
    finish(query)
    return query.lastProgress.stateOperators[0], {(r.tracker_id, r.frame): r for r in spark.read.parquet(out).collect()}


def test_late_points_take_their_place_and_state_has_fps_points(spark):
    where = [new_folder(spark, n) for n in ("in", "out", "position")]
    state, got = speed_run(spark, *where, [("a", 1, 1, 0.0, 0.0), ("a", 1, 3, 20.0, 0.0), ("a", 2, 1, 0.0, 0.0)])
    assert {k: r.points for k, r in got.items()} == {(1, 1): 1, (1, 3): 2, (2, 1): 1}
    # Frame 2 comes late: it is the second point, two metres on. The speed of frame 3 is out already.
    state, late = speed_run(spark, *where, [("a", 1, 2, 2.0, 0.0), ("a", 1, 400, 30.0, 0.0)])
    assert (late[1, 2].points, late[1, 2].speed_kmh) == pytest.approx((2, 2 / (2 / 5) * 3.6))
    assert late[1, 400].points == 4 and late[1, 3] == got[1, 3]
    # Many points later a track still keeps five; the batch wrote one track's state, not both.
    state, more = speed_run(spark, *where, [("a", 1, 500 + f, float(f), 0.0) for f in range(40)])
    assert more[1, 539].points == 5
    assert state.numRowsTotal <= 6 + 2 and state.numRowsUpdated <= 6


def test_speed_state_is_forgotten(spark):
    path, out, position = (new_folder(spark, n) for n in ("in", "out", "position"))
    schema = "source_id string, tracker_id int, frame int, mx double, my double, ts timestamp"

    def run(*rows):
        given = [(s, t, f, x, 0.0, T0 + timedelta(seconds=at)) for s, t, f, x, at in rows]
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.read_file_stream(spark, path, schema)
        query = tracks.start_track_speed(stream, out, position, 5.0, forget="10 seconds", watermark="2 seconds")
        finish(query)
        points = {(r.tracker_id, r.frame): r.points for r in spark.read.parquet(out).collect()}
        return query.lastProgress.stateOperators[0].numRowsTotal, points

    run(("a", 1, 1, 0.0, 0), ("b", None, 1, 0.0, 9))
    # At 14 seconds less 2 the first track has been unseen for more than ten, the second has not.
    run(("c", 3, 1, 0.0, 14))
    total, points = run(("a", 1, 2, 5.0, 15), ("b", None, 2, 5.0, 15))
    assert points == {(1, 1): 1, (None, 1): 1, (3, 1): 1, (1, 2): 1, (None, 2): 2}
    run(("d", 4, 1, 0.0, 1_000))
    total, _ = run(("d", 4, 2, 0.0, 2_000))
    assert total <= 5  # one track: two points, their count, its time and timer


def test_running_visits_close_and_leave_the_state(spark):
    """Two batches: a visit goes on, one closes within a batch, all close behind the watermark."""
    path, out, position = (new_folder(spark, n) for n in ("in", "out", "position"))
    schema = "source_id string, tracker_id int, frame int, ts timestamp, speed_kmh double"

    def run(*rows):
        given = [(s, t, f, T0 + timedelta(seconds=at), v) for s, t, f, at, v in rows]
        spark.createDataFrame(given, schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.read_file_stream(spark, path, schema)
        query = (
            tracks.running_visits(stream, "5 seconds", "2 seconds").writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", position).trigger(availableNow=True).start()
        )
        finish(query)
        found = [
            (r.source_id, r.tracker_id, r.frame, (r.seen - T0).total_seconds(), (r.visit_start - T0).total_seconds(), r.observations, r.avg_speed, r.closed)
            for r in spark.read.parquet(out).collect()
        ]
        return query.lastProgress.stateOperators[0].numRowsTotal, sorted(found, key=str)

    first = [("a", 1, 1, 0, 10.0), ("a", 1, 2, 5, 20.0), ("a", 2, 1, 0, 8.0), ("a", 2, 2, 6, 4.0), ("a", 3, 1, 5, None)]
    _, got = run(*first)
    want = [
        ("a", 1, 1, 0, 0, 1, 10.0, False), ("a", 1, 2, 5, 0, 2, 15.0, False),
        ("a", 2, 1, 0, 0, 1, 8.0, False), ("a", 2, None, 5, 0, 1, 8.0, True), ("a", 2, 2, 6, 6, 1, 4.0, False),
    ]
    assert got == sorted(want, key=str)
    # Track 1 goes on and takes a point that comes late; track 2 is not seen any more.
    _, got = run(("a", 1, 4, 8, 30.0), ("a", 1, 3, 6, 40.0))
    want += [("a", 1, 3, 6, 0, 3, 70 / 3, False), ("a", 1, 4, 8, 0, 4, 25.0, False)]
    assert got == sorted(want, key=str)
    total, got = run((None, 9, 1, 1_000, 1.0))
    want += [("a", 1, None, 13, 0, 4, 25.0, True), ("a", 2, None, 11, 6, 1, 4.0, True), (None, 9, 1, 1_000, 1_000, 1, 1.0, False)]
    assert got == sorted(want, key=str)
    # One visit is open: its value and its timer, kept by key and by time.
    assert total <= 3


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_session_zone_plays_no_part(spark, zone):
    """Half-hour zones and changing clocks: windows start at whole hours of the local time."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path, folder = new_folder(spark, "in"), new_folder(spark, "out")
        night = datetime(2024, 3, 10, 2, 30)
        send(spark, path, [(night, "a", 1, 50), (T0 - timedelta(days=90), "b", 1, 50)])
        got = run_live(spark, path, folder, window="1 hour", watermark="200 days")
        assert got["a"].window_start == datetime(2024, 3, 10, 2) and got["b"].window_start.minute == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sessions_close_after_the_gap(spark):
    rows = [("a", 1, T0 + timedelta(seconds=s), 10.0) for s in (0, 4, 8, 13, 19)]
    df = spark.createDataFrame(rows, "source_id string, tracker_id int, ts timestamp, speed_kmh double")
    got = windows.track_sessions(df).orderBy("session_start").collect()
    assert [(r.session_start.second, r.observations) for r in got] == [(0, 4), (19, 1)]


def test_latest_window_of_a_batch_wins(spark):
    live_windows = aggregates.live_windows(
        spark.createDataFrame(
            [("a", 1, 10.0, 0.9, T0), ("a", 1, 20.0, 0.9, T0 + timedelta(seconds=7))],
            "source_id string, tracker_id int, speed_kmh double, confidence double, event_time timestamp_ntz",
        )
    )
    assert aggregates.latest_per_source(live_windows).first().avg_speed == 20.0


def test_messages_are_parsed_once_however_they_are_filtered(spark):
    sent = spark.createDataFrame([('{"source_id":"a","tracker_id":1}',), ("{", ), (None,)], "value string")
    decoded = streams.decode(sent)
    assert sorted((r.source_id, r.tracker_id) for r in decoded.collect() if r.source_id) == [("a", 1)]
    assert decoded.count() == 3
    timed = live.event_times(filters.valid_live(streams.decode(sent)))
    plan = timed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


def test_message_files_can_be_split(spark, monkeypatch):
    monkeypatch.setattr(runs, "GROUP_BYTES", 64 * 1024)
    path = new_folder(spark, "messages")
    text = F.sha2(F.col("id").cast("string"), 512)
    runs.write_files(spark.range(20_000).select(text.alias("value")), path, 1)
    (file,) = pathlib.Path(path.removeprefix("file:")).glob("*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1


def test_messages_are_made_by_many_tasks_from_one_row_group(spark, monkeypatch):
    n = F.col("event_id")
    rows = spark.range(2_000).select(F.col("id").alias("event_id")).select(
        n, (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(mins=n)).alias("ts"),
        (n % 50).alias("user_id"), F.lit("click").alias("event_type"), (n % 90).cast("double").alias("value"),
    )
    folder = new_folder(spark, "tables")
    rows.coalesce(1).write.parquet(f"{folder}/events.parquet")
    made = []

    def counted(df, path, *files):
        made.append((df.count(), df.rdd.getNumPartitions()))
        write_files(df, path, *files)

    monkeypatch.setattr(queries, "write_files", counted)
    found = queries.stream_watermark(spark, folder)
    assert [c for c, _ in made] == [2_000, 1, 2_000]
    assert made[0][1] >= 8 and made[2][1] >= 8
    # The tick and the late copies, a year back, add no window.
    first, last = found.agg(F.min("window_start"), F.max("window_end")).first()
    assert datetime(2024, 1, 1) <= first < last <= datetime(2024, 1, 2, 10)


def test_a_key_gives_one_frame_with_the_visits_that_are_over():
    class Value:
        def __init__(self, row):
            self.row = row

        def get(self):
            return self.row

        def update(self, row):
            self.row = row

    class Handle:
        timers = [12]

        def deleteTimer(self, at):
            self.timers.remove(at)

        def registerTimer(self, at):
            self.timers.append(at)

    visits = tracks.RunningVisits(10_000)
    visits.handle, visits.visit = Handle(), Value((1_000, 1_000, 2, 7.0))
    rows = pd.DataFrame({"frame": [9, 3, None], "micros": [90_000, 40_000, 40_000], "speed_kmh": [5.0, 1.0, 2.0]})
    (frame,) = visits.handleInputRows(("a", 1), iter([rows]), None)
    assert frame[["micros", "visit_micros", "observations", "avg_speed", "closed"]].values.tolist() == [
        [40_000, 40_000, 1, 1.0, False], [40_000, 40_000, 2, 1.5, False], [90_000, 90_000, 1, 5.0, False],
        [11_000, 1_000, 2, 3.5, True], [50_000, 40_000, 2, 1.5, True],
    ]
    assert [None if pd.isna(f) else int(f) for f in frame["frame"]] == [3, None, 9, None, None]
    assert visits.visit.row == (90_000, 90_000, 1, 5.0) and Handle.timers == [101]
