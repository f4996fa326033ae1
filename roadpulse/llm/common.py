"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words after lower-casing A-Z: runs of a-z, 0-9 and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TO_LOWER = str.maketrans(UPPER, LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character alone."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text as an array; null gives an empty array."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)
    return F.array_remove(parts, "")


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of few rows, so that what is made from long texts at once stays small.

    Python processes outlive their tasks, so freed Arrow memory is handed back after every batch.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        pa.default_memory_pool().release_unused()


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def with_computed(df: DataFrame, source: str, out: str, kind: str, start: Callable) -> DataFrame:
    """The rows with column ``out`` of SQL type ``kind``, computed from column ``source`` in the tasks.

    ``start()`` runs once per task and gives a function from an Arrow array to an Arrow array. The
    other columns pass through; a column already named ``out`` is replaced.
    """
    kept = [c for c in df.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in in_parts(batches):
            made = compute(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=[*kept, out])

    own = [F.col(f"`{c}`") for c in kept]
    given = df.select(*own, F.col(f"`{source}`").alias(free_name(df, "source")))
    schema = df.select(*own, F.lit(None).cast(kind).alias(out)).schema
    return given.mapInArrow(run, schema)
