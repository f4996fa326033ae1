"""Keyed merges: their laws, retries, partition swaps; JSON lines and JDBC text."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.operators.joins import snapshot_changes, upsert_rows
from roadpulse.session import new_folder, path_exists
from roadpulse.sources import tables

ROW = "k int, v int, created_at int"
BATCH = st.dictionaries(st.integers(0, 6), st.one_of(st.none(), st.integers(0, 9)), max_size=6)


def frame(spark, batch, stamp):
    return spark.createDataFrame([(k, v, stamp) for k, v in batch.items()], ROW)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(BATCH, BATCH)
def test_upsert_laws(spark, first, second):
    merged = upsert_rows(frame(spark, first, 1), frame(spark, second, 2), ["k"])
    got = {r.k: (r.v, r.created_at) for r in merged.collect()}
    want = {k: (v, 1) for k, v in first.items()}
    for k, v in second.items():
        want[k] = (v, want[k][1] if k in want else 2)
    assert got == want
    again = upsert_rows(merged, frame(spark, second, 3), ["k"]).collect()
    assert {r.k: (r.v, r.created_at) for r in again} == want
    assert len(again) == len(want)


def test_older_rows_do_not_replace_newer_ones(spark):
    schema = "k int, w int, v string, created_at int"
    stored = spark.createDataFrame([(1, 5, "kept", 0), (2, 5, "old", 0)], schema)
    incoming = spark.createDataFrame([(1, 4, "late", 9), (2, 5, "same", 9), (3, 1, "new", 9)], schema)
    got = upsert_rows(stored, incoming, ["k"], newest="w").collect()
    assert {r.k: (r.v, r.created_at) for r in got} == {1: ("kept", 0), 2: ("same", 0), 3: ("new", 9)}


def hours(spark, rows):
    schema = "window_start timestamp_ntz, source_id string, n int, created_at int"
    return spark.createDataFrame(rows, schema)


DAY = datetime(2024, 1, 1)
KEY = ["window_start", "source_id"]


def put(rows, table, writer, batch, day_of="window_start"):
    return tables.upsert_table(rows, table, writer, batch, KEY, day_of=day_of)


def content(spark, table):
    return sorted((r.window_start.day, r.source_id, r.n, r.created_at) for r in tables.read_table(spark, table).collect())


def test_partitioned_upsert_rewrites_touched_days_only(spark):
    table = new_folder(spark, "t")
    days = [DAY + timedelta(days=d) for d in range(4)]

    def files():
        df = tables.read_table(spark, table).select(F.to_date("window_start").alias("d"), F.input_file_name().alias("f"))
        return {(r.d, r.f) for r in df.collect()}

    put(hours(spark, [(d, "a", 1, 1) for d in days]), table, "w", 0)
    before = files()
    put(hours(spark, [(days[1], "a", 2, 2), (days[1], "b", 2, 2), (days[3], "a", 2, 2)]), table, "w", 1)
    assert {x for x in files() if x[0].day in (1, 3)} == {x for x in before if x[0].day in (1, 3)}
    assert content(spark, table) == [(1, "a", 1, 1), (2, "a", 2, 1), (2, "b", 2, 2), (3, "a", 1, 1), (4, "a", 2, 1)]


@pytest.mark.parametrize("day_of", [None, "window_start"])
def test_a_batch_lost_half_way_is_finished_by_its_repeat(spark, day_of, monkeypatch):
    """One of two days is written, then the driver is lost; another run goes first, then the repeat."""
    table, second = new_folder(spark, "t"), DAY + timedelta(days=1)
    put(hours(spark, [(DAY, "a", 1, 1), (second, "a", 1, 1)]), table, "w", 0, day_of)
    batch = [(DAY, "b", 2, 2), (DAY, "a", 2, 2), (second, "b", 2, 2)]
    put(hours(spark, batch[:2]), table, "w", 1, day_of)
    put(hours(spark, [(DAY, "c", 3, 3), (DAY, "b", 3, 3)]), table, "another run", 0, day_of)
    assert put(hours(spark, batch), table, "w", 1, day_of)
    # What another run has set since is set again by the repeat, as it cannot be told from a first delivery.
    assert content(spark, table) == [(1, "a", 2, 1), (1, "b", 2, 2), (1, "c", 3, 3), (2, "a", 1, 1), (2, "b", 2, 2)]
    assert spark.read.parquet(table).where("set_by = 'w' AND set_in = 1").count() == 3


def test_repeating_an_old_batch_does_not_undo_newer_ones(spark):
    table = new_folder(spark, "t")
    batches = [hours(spark, [(DAY, "a", n, n)]) for n in (1, 2)]
    for n in (0, 1, 0):
        assert put(batches[n], table, "w", n)
    assert tables.read_table(spark, table).first().n == 2


def test_a_new_checkpoint_starts_its_numbers_anew(spark):
    """Batch 0 of another stream is another batch."""
    table = new_folder(spark, "t")
    put(hours(spark, [(DAY, "a", 1, 1)]), table, "first checkpoint", 0)
    put(hours(spark, [(DAY, "a", 2, 2)]), table, "second checkpoint", 0)
    assert content(spark, table) == [(1, "a", 2, 1)]


def test_rows_without_a_day_and_columns_of_the_table(spark):
    table = new_folder(spark, "t")
    put(hours(spark, [(None, "a", 1, 1), (DAY, "a", 1, 1)]), table, "w", 0)
    put(hours(spark, [(DAY, "a", 2, 2)]), table, "w", 1)
    found = tables.read_table(spark, table)
    assert found.columns == ["window_start", "source_id", "n", "created_at"]
    assert sorted((str(r.window_start), r.n) for r in found.collect()) == [(str(DAY), 2), ("None", 1)]
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, new_folder(spark, "none"))


def test_empty_batch_is_skipped(spark):
    table = new_folder(spark, "t")
    for day_of in (None, "window_start"):
        assert not put(hours(spark, []), table, "w", 0, day_of)
    assert not path_exists(spark, table)


def test_jsonl_appends_and_keeps_nulls(spark):
    path = new_folder(spark, "j")
    df = spark.createDataFrame([("cam_01", None), (None, 3)], "source_id string, tracker_id int")
    tables.write_jsonl(df, path)
    tables.write_jsonl(df, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert sorted(set(lines)) == ['{"source_id":"cam_01","tracker_id":null}', '{"source_id":null,"tracker_id":3}']
    assert tables.read_jsonl(spark, path).count() == 4


def test_a_json_stream_writes_each_record_once(spark):
    """Restarted, and with a file of a batch that was lost before it was noted."""
    source, path, position = (new_folder(spark, n) for n in ("in", "out", "position"))
    schema = "source_id string, tracker_id int, ts timestamp_ntz"
    for number in range(2):
        rows = [("a", number, DAY + timedelta(days=i)) for i in range(3)] + [(None, None, None)]
        spark.createDataFrame(rows, schema).coalesce(2).write.mode("append").parquet(source)
        for _ in range(2):
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(source)
            tables.start_jsonl(stream, path, position, by_day="ts").awaitTermination()
        spark.createDataFrame([("lost", 9, DAY)], schema).write.mode("append").json(f"{path}/day=2024-01-01")
    kept = spark.read.schema(f"{schema}, day date").json(path)
    assert sorted(str(r.tracker_id) for r in kept.collect()) == ["0"] * 3 + ["1"] * 3 + ["None"] * 2
    assert kept.where("tracker_id is null").first().asDict() == {"source_id": None, "tracker_id": None, "ts": None, "day": None}
    assert kept.where("day = date'2024-01-02'").count() == 2


def test_database_reads_are_split():
    ranges = tables.jdbc_ranges("id", 0, 1_000, 8)
    assert ranges == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "1000", "numPartitions": "8", "fetchsize": "10000"}
    days = tables.jdbc_days("window_end", DAY.date(), DAY.date() + timedelta(days=2))
    assert days == [
        "window_end >= '2024-01-01' AND window_end < '2024-01-02'",
        "window_end >= '2024-01-02' AND window_end < '2024-01-03'",
    ]
    for bad in ((0, 1, 0), (2, 1, 4)):
        with pytest.raises(ValueError):
            tables.jdbc_ranges("id", *bad)
    with pytest.raises(ValueError):
        tables.read_jdbc(None, {**tables.jdbc_options("jdbc:x", "t"), **ranges}, days)


def test_jdbc_texts():
    text = tables.jdbc_upsert_sql("t", "t_new", ["k", "v", "created_at"], ["k"], ("created_at",))
    assert text == (
        "INSERT INTO t (k, v, created_at) SELECT k, v, created_at FROM t_new "
        "ON CONFLICT (k) DO UPDATE SET v = EXCLUDED.v"
    )
    options = tables.jdbc_options("jdbc:x", "t", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "t", "batchsize": "10000", "user": "u"}


def test_snapshot_changes(spark):
    schema = "source_id string, total_vehicles int, avg_speed double, max_speed double, traffic_status string, last_update string"
    before = spark.createDataFrame([("a", 1, 1.0, 1.0, "X", None), ("b", 1, 1.0, 1.0, "X", "t"), ("c", 1, 1.0, 1.0, "X", "t")], schema)
    after = spark.createDataFrame([("a", 1, 1.0, 1.0, "X", None), ("b", 1, 1.0, 1.0, "Y", "t"), ("d", None, None, None, None, None)], schema)
    got = {r.source_id: r.changed for r in snapshot_changes(before, after).collect()}
    assert got == {"a": False, "b": True, "c": True, "d": True}


def test_written_columns_keep_the_contract(spark, small):
    from roadpulse import schema as S
    from workload import inputs as I

    stamp = F.lit(DAY).cast("timestamp_ntz")
    assert S.schema_violations(I.snapshot_rows(spark, small), S.LIVE_SNAPSHOT_SCHEMA) == []
    for rows, declared, name in (
        (I.hourly_totals(spark, small), S.HOURLY_SUMMARY_SCHEMA, "hourly_summary"),
        (I.hourly_by_type(spark, small), S.HOURLY_BY_TYPE_SCHEMA, "hourly_by_type"),
    ):
        assert S.schema_violations(rows, declared) == []
        filled = S.with_defaults(rows, S.DEFAULTS[name], stamp)
        assert filled.where("created_at is null").isEmpty()
        needed = [f.name for f in declared.fields if not f.nullable]
        found = S.contract_violations(filled, needed, S.LENGTHS[name], S.SUMMARY_KEY if name == "hourly_summary" else S.TYPE_KEY)
        assert {r.violations for r in found.collect()} == {0}


def test_defaults_listing_and_no_rules(spark):
    from roadpulse import schema as S

    df = spark.createDataFrame([("a", None), ("b", 3)], "source_id string, total_count int")
    filled = S.with_defaults(df, S.DEFAULTS["live_history"], F.lit(DAY).cast("timestamp_ntz"))
    assert [(r.total_count, r.created_at) for r in filled.collect()] == [(0, DAY), (3, DAY)]
    listed = [tuple(r) for r in S.column_listing(df).collect()]
    assert listed == [(1, "source_id", "string", True), (2, "total_count", "int", True)]
    assert S.contract_violations(df).collect() == []
    history = spark.createDataFrame([], S.LIVE_HISTORY_SCHEMA)
    assert S.schema_violations(history, S.LIVE_HISTORY_SCHEMA) == []
