"""Files and published tables."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.filters import between
from roadpulse.operators.joins import upsert_rows
from roadpulse.schema import EVENT_SCHEMA
from roadpulse.session import path_exists, read_text


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append rows as JSON lines; null fields are written too."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def start_jsonl(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, by_day: str | None = None
) -> StreamingQuery:
    """Append a stream's rows as JSON lines, each exactly once.

    The file sink notes the files of every batch beside the data; a batch that is repeated after a crash
    replaces its own files in the note, and ``read_jsonl`` reads those that are noted. With ``by_day`` the
    lines lie in a folder per date of that column.
    """
    rows = stream.withColumn("day", F.to_date(by_day)) if by_day else stream
    writer = rows.writeStream.format("json").outputMode("append").option("ignoreNullFields", "false")
    writer = writer.partitionBy("day") if by_day else writer
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_range(
    df: DataFrame,
    columns: list[str],
    time: str,
    start: datetime,
    end: datetime,
    order: list[str],
) -> DataFrame:
    """Chosen columns of a time range [start, end), in order. Range and columns reach the scan."""
    return df.where(between(F.col(time), start, end)).select(*columns).orderBy(*order)


def jdbc_options(url: str, table: str, batch_rows: int = 10_000, **extra: str) -> dict[str, str]:
    """Options of the JDBC reader and writer. Credentials come from the caller."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), **extra}


def jdbc_ranges(column: str, low: int, high: int, parts: int, fetch_rows: int = 10_000) -> dict[str, str]:
    """Reader options that split a table by ranges of a whole-number column, one task and connection each.

    ``low`` and ``high`` only place the borders: rows below, above or without a value are read too.
    """
    if parts < 1 or low > high:
        raise ValueError("parts must be positive and low at most high")
    bounds = {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return {**bounds, "fetchsize": str(fetch_rows)}


def jdbc_days(column: str, start: date, end: date) -> list[str]:
    """Conditions that split a read into a task per day of [start, end), for tables that are queried by time.

    Each reaches the database, whose index on the column then serves it.
    """
    days = [start + timedelta(days=i) for i in range((end - start).days)]
    return [f"{column} >= '{d}' AND {column} < '{d + timedelta(days=1)}'" for d in days]


def read_jdbc(spark: SparkSession, options: dict[str, str], conditions: list[str] | None = None) -> DataFrame:
    """A table of a database, read side by side: by ``jdbc_ranges`` among the options, or a task per condition.

    Without either it is one task, which suits small tables only.
    """
    if conditions is None:
        return spark.read.format("jdbc").options(**options).load()
    if "partitionColumn" in options:
        raise ValueError("split by ranges or by conditions, not both")
    named = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=conditions, properties=named)


def write_staging_jdbc(df: DataFrame, options: dict[str, str]) -> None:
    """Overwrite a staging table of the database."""
    df.write.format("jdbc").options(**options).mode("overwrite").save()


def jdbc_upsert_sql(
    table: str, staging: str, columns: list[str], keys: list[str], keep: tuple[str, ...] = ()
) -> str:
    """Statement by which the database itself merges a staging table into the target."""
    listed = ", ".join(columns)
    changed = [c for c in columns if c not in keys and c not in keep]
    assigned = ", ".join(f"{c} = EXCLUDED.{c}" for c in changed)
    return (
        f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} "
        f"ON CONFLICT ({', '.join(keys)}) DO UPDATE SET {assigned}"
    )


def write_staging(df: DataFrame, path: str) -> DataFrame:
    """Overwrite the staging table of a batch and read it back, which evaluates ``df`` once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Columns of a published table beside its own: the part it is kept by, and the batch that last set the row.
PART, WRITER, BATCH = "part", "set_by", "set_in"


def upsert_table(
    incoming: DataFrame,
    table: str,
    writer: str,
    batch: int,
    keys: list[str],
    keep: tuple[str, ...] = ("created_at",),
    newest: str | None = None,
    day_of: str | None = None,
) -> bool:
    """Merge a batch into a published table; False when the batch is empty.

    The table is plain Parquet, kept by the date of ``day_of`` (by one part without it). Parts that occur in
    the batch are read, merged and written over by Spark's dynamic partition overwrite, so the cost does not
    grow with the history. One writer at a time; readers should start anew while a part is replaced, or the
    rows be handed to a table format that keeps versions.

    ``writer`` and the rising number ``batch`` are kept with each row, so a batch that is repeated, whole or
    after a crash half-way, changes only what it has not set yet and undoes nothing newer: for a stream take
    ``stream_id``, which a new checkpoint gives anew, for a job its run.
    """
    spark = incoming.sparkSession
    part = F.coalesce(F.to_date(day_of).cast("string"), F.lit("none")) if day_of else F.lit("all")
    marks = {PART: part, WRITER: F.lit(writer), BATCH: F.lit(batch).cast("bigint")}
    rows = incoming.withColumns(marks).persist()
    try:
        touched = [r[PART] for r in rows.select(PART).distinct().collect()]
        if not touched:
            return False
        merged = rows
        if path_exists(spark, table):
            stored = _stored(spark, table).where(F.col(PART).isin(touched)).select(*rows.columns)
            merged = upsert_rows(stored, _not_set_yet(rows, stored, keys), keys, (*keep, PART), newest)
        # Rebalancing gathers the rows of a day in few files, yet lets AQE split a day that is large.
        spread = merged.hint("rebalance", PART).sortWithinPartitions(PART, *keys)
        spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(table)
    finally:
        rows.unpersist()
    return True


def _not_set_yet(rows: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a batch without those that it, or a later batch of the same writer, has set already."""
    known = stored.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(WRITER).alias("_by"), F.col(BATCH).alias("_in"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    return rows.join(known, [*same, F.col(WRITER) == F.col("_by"), F.col(BATCH) <= F.col("_in")], "left_anti")


def _stored(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).withColumn(PART, F.col(PART).cast("string"))


def read_table(spark: SparkSession, table: str) -> DataFrame:
    """A table written by ``upsert_table``, as it is now."""
    if not path_exists(spark, table):
        raise FileNotFoundError(f"{table} has not been written")
    return spark.read.parquet(table).drop(PART, WRITER, BATCH)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a running stream's checkpoint was given; a new checkpoint has another."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
