"""Live pipeline: messages -> short windows -> one current row per camera."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from roadpulse import constants as C
from roadpulse.functions import clock
from roadpulse.operators import aggregates, filters, projections
from roadpulse.schema import LIVE_KEY
from roadpulse.sources.streams import decode
from roadpulse.sources.tables import stream_id, upsert_table


def event_times(events: DataFrame, watermark: str = C.LIVE_WATERMARK) -> DataFrame:
    """Valid events with a watermarked event time, the local time as an instant (``clock.as_instant``)."""
    local = clock.parse_local_time(F.col("timestamp"))
    # The filter tests the local time, which is cheaper than the instant and null for the same rows.
    timed = events.where(local.isNotNull()).withColumn("event_time", clock.as_instant(local))
    return timed.withWatermark("event_time", watermark)


def live_window_stream(
    messages: DataFrame,
    window: str = C.LIVE_WINDOW,
    watermark: str = C.LIVE_WATERMARK,
    rsd: float = 0.05,
    exact: bool = False,
) -> DataFrame:
    """Decoded, filtered and windowed stream with traffic status; see ``live_windows``."""
    timed = event_times(filters.valid_live(decode(messages)), watermark)
    return aggregates.live_windows(timed, window, exact=exact, rsd=rsd)


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    """Window bounds back to wall-clock times, as tables store them."""
    names = columns or ("window_start", "window_end")
    return df.withColumns({c: clock.as_wall_clock(F.col(c)) for c in names})


class SnapshotWriter:
    """``foreachBatch`` sink that keeps one current row per camera.

    A batch that Spark repeats is merged once; batches are told apart by the stream's checkpoint and
    their number. Errors are raised: the batch is then repeated instead of being lost.
    """

    def __init__(
        self, table: str, checkpoint: str, mode: str = "latest", stamp: Column | None = None
    ) -> None:
        self.table = table
        self.checkpoint = checkpoint
        self.mode = mode
        self.stamp = stamp

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stamp = F.current_timestamp().cast("timestamp_ntz") if self.stamp is None else self.stamp
        newest = aggregates.latest_per_source(zoneless(batch), self.mode)
        upsert_table(
            projections.live_row(newest, stamp),
            self.table,
            stream_id(batch.sparkSession, self.checkpoint),
            batch_id,
            LIVE_KEY,
            newest="window_start",
        )


def start_live(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    window: str = C.LIVE_WINDOW,
    watermark: str = C.LIVE_WATERMARK,
    trigger: dict | None = None,
    mode: str = "latest",
    stamp: Column | None = None,
    rsd: float = 0.05,
    exact: bool = False,
) -> StreamingQuery:
    """Run the live pipeline; by default every 30 seconds.

    ``rsd`` is the relative error of the vehicle counts, on which the status depends; ``exact`` keeps
    every tracker of an open window in the state instead.
    """
    windows = live_window_stream(messages, window, watermark, rsd, exact)
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(SnapshotWriter(table, checkpoint, mode, stamp))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": C.LIVE_TRIGGER}))
        .start()
    )


class BatchTableWriter:
    """``foreachBatch`` sink that writes each batch to its own folder; repeats overwrite it."""

    def __init__(self, table: str) -> None:
        self.table = table

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.table}/batch={batch_id}")


def window_state(changes: DataFrame) -> DataFrame:
    """Current value of every window from the changes an update-mode stream has emitted."""
    fields = [c for c in changes.columns if c not in ("batch", "source_id", "window_start")]
    newest = F.max_by(F.struct(*fields), "batch").alias("r")
    return changes.groupBy("source_id", "window_start").agg(newest).select(
        "source_id", "window_start", "r.*"
    )


