"""Hourly pipeline on a stream: whole hours only, however the input is split into runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import constants as C
from roadpulse.functions import clock
from roadpulse.functions.traffic import rounded
from roadpulse.operators import filters
from roadpulse.plans.hourly import HourlyTables
from roadpulse.sources.streams import decode
from roadpulse.sources.tables import stream_id
from roadpulse.streaming.live import event_times


def vehicle_stream(
    messages: DataFrame,
    watermark: str = "1 hour",
    window_minutes: int = C.HOURLY_WINDOW_MINUTES,
) -> DataFrame:
    """Vehicle rows of each hour as one stateful aggregate.

    The type is the most frequent one (ties: smallest name); a streaming plan cannot count per
    type first without a second state store.
    """
    timed = event_times(filters.valid_batch(decode(messages)), watermark)
    grouped = timed.groupBy(
        F.window("event_time", clock.minutes(window_minutes)).alias("w"), "source_id", "tracker_id"
    )
    return grouped.agg(
        F.mode("vehicle_type", True).alias("vehicle_type"),
        F.avg("speed_kmh").alias("avg_speed"),
        F.count("speed_kmh").alias("count_observations"),
    )


def total_stream(vehicles: DataFrame, window_minutes: int = C.HOURLY_WINDOW_MINUTES) -> DataFrame:
    """Second chained aggregate: per hour and camera. Append mode only."""
    hour = F.window(F.window_time("w"), clock.minutes(window_minutes)).alias("h")
    totals = vehicles.groupBy(hour, "source_id").agg(
        F.count("*").cast("int").alias("total_vehicles"),
        rounded(F.avg("avg_speed"), 2).alias("avg_speed_kmh"),
    )
    return totals.select(
        F.col("h.start").alias("window_start"),
        F.col("h.end").alias("window_end"),
        "source_id",
        "total_vehicles",
        "avg_speed_kmh",
    )


def start_hourly(
    messages: DataFrame,
    tables: HourlyTables,
    checkpoint: str,
    watermark: str = "1 hour",
    stamp: Column | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish both summaries of every hour that has closed.

    In append mode all vehicle rows of an hour leave the state in one batch, so the summaries of
    that batch are complete. One state serves both tables.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
        vehicles = batch.withColumn("window_start", clock.as_wall_clock(F.col("w.start")))
        vehicles = vehicles.drop("w").persist()
        try:
            tables.publish(vehicles, stream_id(batch.sparkSession, checkpoint), batch_id, now)
        finally:
            vehicles.unpersist()

    return (
        vehicle_stream(messages, watermark)
        .writeStream.outputMode("append")
        .foreachBatch(publish)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
