"""The record log: order, limits, restarts, ends that are fixed beforehand."""

import os
import pathlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from roadpulse.session import CHECKPOINT_FILES, new_folder, plain_checkpoints
from roadpulse.sources import record_log as R


def add(spark, path, first, count, partitions=3):
    rows = spark.range(first, first + count).select(F.col("id").cast("string").alias("value"))
    return R.append_log(rows, path, F.col("value"), partitions, [F.col("value").cast("int")])


def run(stream, table, position):
    """Batches that a run wrote, as lists of (partition, offset, value)."""
    batches = {}

    def keep(batch, number):
        batches[number] = sorted((r.partition, r.offset, r.value) for r in batch.collect())

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", position).trigger(processingTime="0 seconds")
    R.drained(query.start())
    return [batches[n] for n in sorted(batches) if batches[n]]


def test_limits_restarts_and_fixed_ends(spark):
    path, position = new_folder(spark, "log"), new_folder(spark, "position")
    assert add(spark, path, 0, 100) == 0
    ends = R.log_ends(path)
    assert sum(ends.values()) == 100
    assert add(spark, path, 100, 55) == 1
    first = run(R.read_log_stream(spark, path, 30, ends), None, position)
    assert [len(b) for b in first] == [30, 30, 30, 10]
    # The restart goes on at the offset; a segment without its mark is not there yet.
    spark.range(5).select(F.col("id").cast("string").alias("value")).write.parquet(f"{path}/segment=000000000002/partition=0")
    second = run(R.read_log_stream(spark, path, 30), None, position)
    assert [len(b) for b in second] == [30, 25]
    assert add(spark, path, 155, 5) == 3
    third = run(R.read_log_stream(spark, path, None), None, position)
    assert [len(b) for b in third] == [5]
    everything = sorted(r for b in first + second + third for r in b)
    assert sorted(int(v) for *_, v in everything) == list(range(160))
    for p in range(3):
        own = [(offset, int(v)) for q, offset, v in everything if q == p]
        assert [offset for offset, _ in own] == list(range(len(own)))
        assert [v for _, v in own] == sorted(v for _, v in own)


def test_latest_start_and_an_empty_log(spark):
    path, position = new_folder(spark, "log"), new_folder(spark, "position")
    assert R.log_ends(path) == {} and run(R.read_log_stream(spark, path, 10), None, position) == []
    add(spark, path, 0, 20)
    late = new_folder(spark, "late")
    assert run(R.read_log_stream(spark, path, 10, starting="latest"), None, late) == []
    add(spark, path, 20, 7)
    assert [len(b) for b in run(R.read_log_stream(spark, path, 10), None, position)] == [10, 10, 7]


@pytest.mark.parametrize("limit", [None, 0, 1, 7, 1_000])
def test_shares_of_a_limit(limit):
    start, ends = {"0": 5, "2": 1}, {"0": 5, "1": 90, "2": 11, "10": 3}
    got = R.admitted(start, ends, limit)
    taken = {p: got[p] - start.get(p, 0) for p in got}
    assert list(got) == ["0", "1", "2", "10"] and taken["0"] == 0
    assert sum(taken.values()) == min(103 if limit is None else limit, 103)
    assert all(0 <= taken[p] <= ends[p] - start.get(p, 0) for p in got)
    assert R.admitted(got, ends, None) == {"0": 5, "1": 90, "2": 11, "10": 3}


def test_a_batch_reads_the_row_groups_of_its_records_only(spark, monkeypatch):
    path = new_folder(spark, "log")
    long = F.concat(F.col("id").cast("string"), F.lit(":"), F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 256))
    R.append_log(spark.range(40_000).select(long.alias("value")), path, F.lit("one"), 1, [F.split("value", ":")[0].cast("int")])
    reader = R.RecordLogReader({"path": path})
    # One partition, written by several tasks, which share its order.
    (task,) = reader.partitions({}, {"0": 40_000})
    assert len(task.slices) > 1
    everything = [(o, v) for b in reader.read(task) for o, v in zip(b["offset"].to_pylist(), b["value"].to_pylist())]
    assert [o for o, _ in everything] == list(range(40_000))
    assert [int(v.split(":")[0]) for _, v in everything] == list(range(40_000))
    read, whole = [], R.pq.ParquetFile.iter_batches

    def counted(self, **options):
        for batch in whole(self, **options):
            read.append(batch.num_rows)
            yield batch

    monkeypatch.setattr(R, "GROUP_BYTES", 256 * 1024)
    again = new_folder(spark, "log")
    R.append_log(spark.range(40_000).select(long.alias("value")), again, F.lit("one"), 1, [F.split("value", ":")[0].cast("int")])
    monkeypatch.setattr(R.pq.ParquetFile, "iter_batches", counted)
    reader = R.RecordLogReader({"path": again})
    (task,) = reader.partitions({"0": 39_000}, {"0": 39_010})
    assert [o for b in reader.read(task) for o in b["offset"].to_pylist()] == list(range(39_000, 39_010))
    assert sum(read) < 20_000


def test_tasks_of_a_batch():
    def plain(tasks):
        return [[(s.name, s.low, s.high) for s in task] for task in tasks]

    short = [R.Slice(name, 5, 15, 0, 0) for name in "abc"]
    assert plain(R.dealt(short, 30)) == [[("a", 5, 15), ("b", 5, 15), ("c", 5, 15)]]
    assert plain(R.dealt(short, 20)) == [[("a", 5, 15), ("b", 5, 15)], [("c", 5, 15)]]
    assert plain(R.dealt(short[:1], 4)) == [[("a", 5, 9)], [("a", 9, 13)], [("a", 13, 15)]]
    assert R.dealt([], 4) == []
    assert R.groups_of([10, 10, 10], 10, 20) == ([1], 10)
    assert R.groups_of([10, 10, 10], 9, 21) == ([0, 1, 2], 0)
    assert R.groups_of([10, 0, 10], 25, 30) == ([], 20)


def test_a_small_batch_reads_little_beyond_its_records(spark, monkeypatch):
    path = new_folder(spark, "log")
    long = F.concat(F.col("id").cast("string"), F.lit(":"), F.sha2(F.col("id").cast("string"), 512), F.sha2(F.col("id").cast("string"), 256))
    R.append_log(spark.range(40_000).select(long.alias("value")), path, F.lit("one"), 1, [F.split("value", ":")[0].cast("int")])
    read, whole = [], pq.ParquetFile.iter_batches

    def counted(self, **options):
        for batch in whole(self, **options):
            read.append(batch.num_rows)
            yield batch

    monkeypatch.setattr(pq.ParquetFile, "iter_batches", counted)
    reader = R.RecordLogReader({"path": path})
    (task,) = reader.partitions({"0": 20_000}, {"0": 20_010})
    assert [o for b in reader.read(task) for o in b["offset"].to_pylist()] == list(range(20_000, 20_010))
    assert sum(read) < 4_000


def test_a_whole_segment_is_listed_once(spark, monkeypatch):
    path, listed, selector = new_folder(spark, "log"), [], R.fs.FileSelector

    def counted(base, *args, **options):
        listed.append((pathlib.Path(base).name, options.get("recursive", False)))
        return selector(base, *args, **options)

    add(spark, path, 0, 40)
    monkeypatch.setattr(R.fs, "FileSelector", counted)
    files = R._Files(path)
    files.refresh()
    ends = files.ends()
    assert sum(ends.values()) == 40 and listed[1:] == [("segment=000000000000", True)]
    listed.clear()
    files.refresh()
    assert files.ends() == ends and [recursive for _, recursive in listed] == [False]
    # A segment is met once it has its mark, also after one with a higher number.
    add(spark, path, 40, 10)
    os.rename(f"{path}/segment=000000000001/_SUCCESS", f"{path}/segment=000000000001/_LATER")
    add(spark, path, 50, 5)
    files.refresh()
    assert sum(files.ends().values()) == 45
    os.rename(f"{path}/segment=000000000001/_LATER", f"{path}/segment=000000000001/_SUCCESS")
    files.refresh()
    assert sum(files.ends().values()) == 55
    assert [(p, n) for p, n, _ in files.files] == sorted((p, n) for p, n, _ in files.files)


def test_batches_as_folders(spark):
    path, table, position = (new_folder(spark, n) for n in ("log", "table", "position"))
    rows = spark.range(97).select(F.when(F.col("id") != 5, F.concat(F.lit("ü"), "id")).alias("value"))
    R.append_log(rows, path, F.col("value"), 3)
    R.drained(R.start_batches(R.read_log_stream(spark, path, 30), table, position))
    assert spark.conf.get(CHECKPOINT_FILES, None) is None
    read = spark.read.parquet(table)
    assert dict(read.dtypes) == {"value": "string", "partition": "int", "offset": "bigint", "batch": "int"}
    assert [r["count"] for r in read.groupBy("batch").count().orderBy("batch").collect()] == [30, 30, 30, 7]
    got = sorted((r.value or "") for r in read.collect())
    assert got == sorted([f"ü{i}" for i in range(97) if i != 5] + [""])
    for p, offsets in read.groupBy("partition").agg(F.sort_array(F.collect_list("offset"))).collect():
        assert offsets == list(range(len(offsets)))
    # A batch of one task is one file and nothing else.
    held = sorted(str(f.relative_to(table).parent) for f in pathlib.Path(table).rglob("*") if f.is_file())
    assert held == [f"batch={n}" for n in range(4)]


def test_a_repeated_batch_replaces_the_first(spark):
    path, table, position = (new_folder(spark, n) for n in ("log", "table", "position"))
    add(spark, path, 0, 20)
    R.drained(R.start_batches(R.read_log_stream(spark, path, 10), table, position))
    records = spark.createDataFrame([("again", 0, 0)], "value string, partition int, offset bigint")
    names = records.coalesce(1).mapInArrow(R._records_to(f"{table}/{R.UNDER_WAY}"), "name string")
    # What a lost task left is not read.
    pq.write_table(pa.Table.from_pylist([{"value": "lost", "partition": 0, "offset": 0}], R.RECORD), f"{table}/{R.UNDER_WAY}/lost.parquet")
    sink = R._BatchFolders(table)
    sink(names, 1)
    read = spark.read.parquet(table)
    assert [r.value for r in read.where("batch = 1").collect()] == ["again"]
    assert read.where("batch = 0").count() == 10 and read.count() == 11
    sink(names.limit(0), 1)
    read = spark.read.parquet(table)
    assert read.where("batch = 1").count() == 0 and read.count() == 10


def test_a_chosen_checkpoint_writer_is_kept(spark):
    folder = new_folder(spark, "position")
    with plain_checkpoints(spark, folder):
        assert spark.conf.get(CHECKPOINT_FILES).endswith(".FileSystemBasedCheckpointFileManager")
    assert spark.conf.get(CHECKPOINT_FILES, None) is None
    spark.conf.set(CHECKPOINT_FILES, "chosen")
    try:
        with plain_checkpoints(spark, folder):
            assert spark.conf.get(CHECKPOINT_FILES) == "chosen"
        assert spark.conf.get(CHECKPOINT_FILES) == "chosen"
    finally:
        spark.conf.unset(CHECKPOINT_FILES)
