"""Detection messages: reading them from a topic or files, and decoding them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse import constants as C
from roadpulse.schema import EVENT_SCHEMA

MESSAGE_SCHEMA = T.StructType([T.StructField("value", T.StringType())])


def topic_options(
    servers: str,
    topic: str,
    per_trigger: int | None,
    starting: str = "latest",
    fail_on_data_loss: bool = True,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``per_trigger`` bounds the records of a trigger and must be chosen, None for no bound: a topic that
    grows faster than bound and trigger allow falls behind. ``LIVE_RECORDS_PER_TRIGGER`` is the value of
    the small deployment that the live job was first written for. Lost messages are an error by default.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(per_trigger)
    return {**options, **(extra or {})}


def read_topic_stream(spark: SparkSession, **options) -> DataFrame:
    """Unbounded read of a topic; see ``topic_options``."""
    return spark.readStream.format("kafka").options(**topic_options(**options)).load()


def read_topic_backlog(
    spark: SparkSession, servers: str, topic: str, cap: int | None, fail_on_data_loss: bool = True
) -> DataFrame:
    """Catch-up read for ``availableNow`` runs: from the earliest message on, in capped batches.

    The checkpoint of the query remembers the position. The cap bounds a batch, not the run, so
    no run leaves messages behind.
    """
    return read_topic_stream(
        spark,
        servers=servers,
        topic=topic,
        per_trigger=cap,
        starting="earliest",
        fail_on_data_loss=fail_on_data_loss,
    )


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = MESSAGE_SCHEMA,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """The same stream from files that are added to a folder."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(files_per_trigger))
    return reader.load(path)


def decode(df: DataFrame, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """JSON messages to typed columns. What does not parse becomes null, never an error.

    The columns come out of a generator, past which no filter on them is moved: moved before the parsing,
    each of its columns would parse the message again.
    """
    return df.select(F.inline(F.array(F.from_json(F.col("value").cast("string"), schema))))


def field_coverage(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Per required field: how many messages carry it, and whether none does."""
    fields = fields or C.REQUIRED_COLUMNS
    present = F.json_object_keys(F.col("value").cast("string"))
    counts = df.select(present.alias("keys")).agg(
        *[F.count_if(F.array_contains("keys", f)).alias(f) for f in fields]
    )
    listed = F.array(
        *[F.struct(F.lit(f).alias("column_name"), F.col(f).alias("messages")) for f in fields]
    )
    return counts.select(F.inline(listed)).withColumn("is_missing", F.col("messages") == 0)


def missing_columns(df: DataFrame, required: list[str] | None = None) -> list[str]:
    """Required columns that a table lacks."""
    return [c for c in required or C.REQUIRED_COLUMNS if c not in df.columns]


def decode_checked(
    df: DataFrame, schema: T.StructType = EVENT_SCHEMA, required: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(decoded rows, quarantined messages).

    A message that lacks a required field, or is not JSON, goes to quarantine with the names of
    the fields it lacks. Asking for a column that the schema itself lacks is an error.
    """
    required = required or C.REQUIRED_COLUMNS
    absent = [c for c in required if c not in schema.fieldNames()]
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    text = F.col("value").cast("string")
    wanted = F.array(*[F.lit(c) for c in required])
    lacks = F.array_except(wanted, F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")))
    checked = df.select(text.alias("value"), lacks.alias("missing"))
    good = decode(checked.where(F.size("missing") == 0), schema)
    return good, checked.where(F.size("missing") > 0)


def topic_records(df: DataFrame, key: str = "source_id", spread: str | None = None) -> DataFrame:
    """Rows as messages: JSON value, keyed so that a camera stays in one topic partition.

    With ``spread``, such as the tracker's column, the key names camera and vehicle: a camera with a large
    part of the traffic is then dealt over the partitions, and each vehicle stays in order.
    """
    named = F.col(key).cast("string")
    if spread is not None:
        named = F.concat_ws(":", named, F.col(spread).cast("string"))
    return df.select(named.alias("key"), F.to_json(F.struct("*")).alias("value"))


def producer_options(
    servers: str, topic: str, linger_ms: int = 5, batch_bytes: int = 16384
) -> dict[str, str]:
    """Options of the Kafka sink; the producer groups records itself."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.linger.ms": str(linger_ms),
        "kafka.batch.size": str(batch_bytes),
    }


def write_topic(df: DataFrame, spread: str | None = None, **options) -> None:
    """Publish a batch of rows to a topic."""
    topic_records(df, spread=spread).write.format("kafka").options(**producer_options(**options)).save()


def write_topic_stream(df: DataFrame, checkpoint: str, spread: str | None = None, trigger: dict | None = None, **options):
    """A writer that publishes a stream of rows to a topic; ``start()`` it."""
    return (
        topic_records(df, spread=spread)
        .writeStream.format("kafka")
        .options(**producer_options(**options))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
    )
