"""A log of messages in files, read as a stream with an offset per partition and a limit of records.

A log is a folder of segments, each written whole by ``append_log``: ``segment=N/partition=K/*.parquet``.
A record's offset is its number within its partition, in order of segments and files. Positions lie in the
stream's checkpoint; a batch that is repeated reads the same records. Row counts come from the files' footers.
Files are cut into small row groups, of which a batch reads those that hold its records and no others. A stream
with a limit of records makes many small batches, so what a batch costs whatever its size counts most: a whole
segment is listed once, and ``start_batches`` writes a batch without the folders and marks of a Spark write.
"""

from __future__ import annotations

import itertools
import json
import re
import sys
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from roadpulse.session import plain_checkpoints

# The reader runs in workers that may not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SEGMENT = re.compile(r"segment=(\d+)$")
_FILE = re.compile(r"segment=\d+/partition=(\d+)/[^/_.][^/]*\.parquet$")

# Records that one task reads of a batch; shares of a partition that tasks write; bytes of a row group.
RECORDS_PER_TASK = 50_000
SHARES = 256
GROUP_BYTES = 256 * 1024

# Folder of a table for files of batches that have not ended; the dot makes readers pass it by.
UNDER_WAY = ".under_way"

# A record as it is read: its text, partition and offset.
RECORD = pa.schema([("value", pa.string()), ("partition", pa.int32()), ("offset", pa.int64())])


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """(file system, path on it)."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class _Files:
    """Files and row counts of the whole segments met so far, which never change."""

    def __init__(self, path: str) -> None:
        self.path = path
        self.segments: dict[int, list[tuple[int, str, int]]] = {}
        self.files: list[tuple[int, str, int]] = []

    def refresh(self) -> None:
        system, root = _opened(self.path)
        found = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        new = {int(m[1]): m.string for m in (_SEGMENT.search(i.path) for i in found) if m and int(m[1]) not in self.segments}
        # A segment is listed after its mark was seen, so its files are all there.
        whole = [n for n in sorted(new) if system.get_file_info(f"{new[n]}/_SUCCESS").is_file]
        for number in whole:
            listed = sorted(i.path for i in system.get_file_info(fs.FileSelector(new[number], recursive=True)) if i.is_file)
            self.segments[number] = [(int(m[1]), m.string, self._rows(system, m.string)) for m in map(_FILE.search, listed) if m]
        if whole:
            files = [(partition, number, name, rows) for number, held in self.segments.items() for partition, name, rows in held]
            self.files = [(partition, name, rows) for partition, _, name, rows in sorted(files)]

    def _rows(self, system: fs.FileSystem, name: str) -> int:
        with system.open_input_file(name) as file:
            return pq.read_metadata(file).num_rows

    def ends(self) -> dict[str, int]:
        """Records of each partition."""
        found: dict[str, int] = {}
        for partition, _, rows in self.files:
            found[str(partition)] = found.get(str(partition), 0) + rows
        return found


def admitted(start: dict[str, int], ends: dict[str, int], limit: int | None) -> dict[str, int]:
    """Where a batch ends: at most ``limit`` records in all, shared out by what waits in each partition."""
    waiting = {p: max(end - start.get(p, 0), 0) for p, end in ends.items()}
    total = sum(waiting.values())
    if limit is None or total <= limit:
        taken = waiting
    else:
        taken = {p: n * limit // total for p, n in waiting.items()}
        spare = limit - sum(taken.values())
        for p in sorted(waiting, key=lambda p: (taken[p] - waiting[p], p))[:spare]:
            taken[p] += 1
    return {p: start.get(p, 0) + taken.get(p, 0) for p in sorted({*start, *ends}, key=int)}


class Slice:
    """Rows [low, high) of a file, whose first row has the offset ``base``."""

    def __init__(self, name: str, low: int, high: int, base: int, partition: int) -> None:
        self.name, self.low, self.high, self.base, self.partition = name, low, high, base, partition


class Slices(InputPartition):
    """What one task reads."""

    def __init__(self, slices: list[Slice]) -> None:
        self.slices = slices


def dealt(slices: list[Slice], records: int) -> list[list[Slice]]:
    """Slices by task, of at most ``records`` each: long ones are cut, short ones put together."""
    tasks: list[list[Slice]] = []
    room = 0
    for s in slices:
        low = s.low
        while low < s.high:
            if not room:
                tasks.append([])
                room = records
            high = min(low + room, s.high)
            tasks[-1].append(Slice(s.name, low, high, s.base, s.partition))
            room -= high - low
            low = high
    return tasks


def groups_of(sizes: list[int], low: int, high: int) -> tuple[list[int], int]:
    """(row groups of these sizes that hold rows of [low, high), rows before the first of them)."""
    found, skipped, at = [], 0, 0
    for number, size in enumerate(sizes):
        if at + size <= low:
            skipped = at + size
        elif at < high:
            found.append(number)
        at += size
    return found, skipped


class RecordLogReader(DataSourceStreamReader):
    """Offsets are records per partition. Spark plans the last batch again when a query restarts, which
    tells a new reader where to go on."""

    def __init__(self, options: dict) -> None:
        self.path = options["path"]
        limit = options.get("recordsPerTrigger")
        self.limit = None if limit is None else int(limit)
        self.until = json.loads(options["until"]) if "until" in options else None
        self.from_end = options.get("startingOffsets", "earliest") == "latest"
        self.files = _Files(self.path)
        self.reached: dict[str, int] | None = None

    def initialOffset(self) -> dict:
        if not self.from_end:
            return {}
        self.files.refresh()
        return self.files.ends()

    def latestOffset(self) -> dict:
        if self.reached is None:
            self.reached = self.initialOffset()
        self.files.refresh()
        ends = self.files.ends()
        if self.until is not None:
            ends = {p: min(n, self.until.get(p, 0)) for p, n in ends.items()}
        # Spark may ask more than once before it plans a batch, which alone moves the position.
        return admitted(self.reached, ends, self.limit)

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        self.reached = end
        self.files.refresh()
        found, base = [], {}
        for partition, name, rows in self.files.files:
            p = str(partition)
            first = base.get(p, 0)
            base[p] = first + rows
            low, high = max(start.get(p, 0), first), min(end.get(p, 0), first + rows)
            if low < high:
                found.append(Slice(name, low - first, high - first, first, partition))
        return [Slices(task) for task in dealt(found, RECORDS_PER_TASK) or [[]]]

    def read(self, partition: Slices) -> Iterator[pa.RecordBatch]:
        system, _ = _opened(self.path)
        for part in partition.slices:
            with system.open_input_file(part.name) as file:
                yield from self._records(pq.ParquetFile(file), part)

    def _records(self, file: pq.ParquetFile, part: Slice) -> Iterator[pa.RecordBatch]:
        sizes = [file.metadata.row_group(n).num_rows for n in range(file.num_row_groups)]
        groups, at = groups_of(sizes, part.low, part.high)
        for batch in file.iter_batches(row_groups=groups, columns=["value"]):
            low, high = max(part.low - at, 0), min(part.high - at, batch.num_rows)
            if low < high:
                rows = high - low
                first = part.base + at + low
                columns = [
                    batch.column(0).slice(low, rows).cast(pa.string()),
                    pa.array([part.partition] * rows, pa.int32()),
                    pa.array(range(first, first + rows), pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=RECORD)
            at += batch.num_rows


class RecordLog(DataSource):
    """Format ``record_log``: columns value, partition, offset. Options: path; recordsPerTrigger, at most so
    many records in a batch; until, a JSON object of partition -> offset at which the stream ends;
    startingOffsets, ``earliest`` (default) or ``latest``, for a query without a position."""

    @classmethod
    def name(cls) -> str:
        return "record_log"

    def schema(self) -> str:
        return "value string, partition int, offset bigint"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return RecordLogReader(self.options)


def append_log(messages: DataFrame, path: str, key: Column, partitions: int = 4, order: list[Column] | None = None) -> int:
    """Add messages (column ``value``) as one segment; the number of the segment.

    Messages with equal ``key`` go to one partition, in the order of ``order``. One writer at a time. A segment
    that a lost driver left unfinished has no mark of success: readers pass it by and the next one has a new number.
    Several tasks share a partition, by ranges of ``order`` or, without one, by the texts; the session's number
    of shuffle partitions bounds what a task holds.
    """
    system, root = _opened(path)
    there = system.get_file_info(fs.FileSelector(root, allow_not_found=True))
    segment = 1 + max((int(m[1]) for m in (_SEGMENT.search(i.path) for i in there) if m), default=-1)
    part = F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")
    rows = messages.withColumn("partition", part)
    if order:
        rows = rows.repartitionByRange("partition", *order).sortWithinPartitions("partition", *order)
    else:
        rows = rows.repartition("partition", F.pmod(F.xxhash64("value", F.lit(0)), F.lit(SHARES)))
    writer = rows.select("value", "partition").write.partitionBy("partition").option("parquet.block.size", GROUP_BYTES)
    writer.parquet(f"{path}/segment={segment:012d}")
    return segment


def log_ends(path: str) -> dict[str, int]:
    """Records that each partition of a log holds now."""
    files = _Files(path)
    files.refresh()
    return files.ends()


def read_log_stream(spark: SparkSession, path: str, per_trigger: int | None, until: dict[str, int] | None = None, starting: str = "earliest") -> DataFrame:
    """Unbounded read of a log; ``per_trigger`` bounds the records of a batch and must be chosen, None for no bound."""
    spark.dataSource.register(RecordLog)
    reader = spark.readStream.format("record_log").option("path", path).option("startingOffsets", starting)
    if per_trigger is not None:
        reader = reader.option("recordsPerTrigger", str(per_trigger))
    if until is not None:
        reader = reader.option("until", json.dumps(until))
    return reader.load()


def _records_to(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does: write its records to one new file of ``folder`` and give the file's name."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        system, root = _opened(folder)
        name = f"{uuid.uuid4().hex}.parquet"
        with system.open_output_stream(f"{root}/{name}") as file, pq.ParquetWriter(file, RECORD) as writer:
            for batch in itertools.chain([first], batches):
                writer.write_batch(batch.select(RECORD.names).cast(RECORD))
        yield pa.RecordBatch.from_pydict({"name": [name]})

    return write


class _BatchFolders:
    """``foreachBatch`` sink: the files that the tasks of a batch name become its folder; repeats overwrite it."""

    def __init__(self, table: str) -> None:
        self.table = table

    def __call__(self, names: DataFrame, batch_id: int) -> None:
        system, root = _opened(self.table)
        written = [r.name for r in names.collect()]
        folder = f"{root}/batch={batch_id}"
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)
        system.create_dir(folder)
        for name in written:
            system.move(f"{root}/{UNDER_WAY}/{name}", f"{folder}/{name}")
        if not written:
            with system.open_output_stream(f"{folder}/none.parquet") as file:
                pq.write_table(RECORD.empty_table(), file)


def start_batches(records: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write a stream of a log's records into a folder per batch, ``table/batch=N``; to be ended by ``drained``.

    Each task writes one file to a folder that readers pass by, and the driver moves the files of the tasks that
    count, so what a lost or repeated task left is never read. The folders, marks and moves of a Spark write,
    several a task, cost more than a batch of a few thousand records does.
    """
    spark = records.sparkSession
    system, root = _opened(table)
    system.create_dir(f"{root}/{UNDER_WAY}")
    names = records.mapInArrow(_records_to(f"{table}/{UNDER_WAY}"), "name string")
    writer = names.writeStream.foreachBatch(_BatchFolders(table)).option("checkpointLocation", checkpoint)
    with plain_checkpoints(spark, checkpoint):
        return writer.trigger(processingTime="0 seconds").start()


def drained(query: StreamingQuery) -> StreamingQuery:
    """Wait until a query has read all that its sources admit, and stop it.

    With ``until`` set to ``log_ends`` at the start, a backlog of any size is taken in batches of the record
    limit and nothing is left behind, while messages that arrive meanwhile wait for the next run.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
