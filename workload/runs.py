"""Running a file stream to its end inside a query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse.functions import clock
from roadpulse.session import apply_runtime_options, new_folder
from workload.inputs import AS_OF


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` run and raise its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def append_stream(
    stream: DataFrame, table: str | None = None, checkpoint: str | None = None
) -> DataFrame:
    """Run an append-mode stream over all available input into a Parquet table."""
    spark = apply_runtime_options(stream.sparkSession)
    table = table or new_folder(spark, "table")
    finish(
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or new_folder(spark, "position"))
        .option("path", table)
        .trigger(availableNow=True)
        .start()
    )
    return spark.read.schema(stream.schema).parquet(table)


def batch_stream(stream: DataFrame, mode: str, sink, checkpoint: str) -> StreamingQuery:
    """Run a stream over all available input into a ``foreachBatch`` sink; the query, which has ended."""
    apply_runtime_options(stream.sparkSession)
    query = (
        stream.writeStream.outputMode(mode)
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    finish(query)
    return query


# Row groups of a stream's files: what one task reads at least, so that the tasks of a batch share its files.
GROUP_BYTES = 4 * 1024 * 1024


def write_files(df: DataFrame, path: str, files: int | None = 8) -> None:
    """Add rows to a stream's folder; with ``files`` None each task that makes them writes its own file."""
    dealt = df if files is None else df.repartition(files)
    dealt.write.mode("append").option("parquet.block.size", GROUP_BYTES).parquet(path)


def with_sentinel(df: DataFrame) -> DataFrame:
    """Add a copy of one row dated 2030. It moves the watermark past all real rows, so that
    append-mode results of these come out; its own window never closes."""
    far = df.limit(1)
    for name, kind in df.dtypes:
        if kind in ("timestamp", "timestamp_ntz"):
            far = far.withColumn(name, F.lit("2030-01-01 00:00:00").cast(kind))
        elif name == "timestamp":
            far = far.withColumn(name, F.lit("2030-01-01 00:00:00"))
    return df.unionByName(far)


def stamp():
    return clock.ntz(AS_OF)


