"""Hourly pipeline: clean events, one row per vehicle, two summaries, merge, check."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.operators import aggregates, filters
from roadpulse.schema import SUMMARY_KEY, TYPE_KEY
from roadpulse.session import written_out
from roadpulse.sources.tables import read_table, upsert_table


def clean_events(events: DataFrame) -> DataFrame:
    """Valid rows with a parsed event time."""
    return filters.parsable_time(filters.valid_batch(events))


def totals(events: DataFrame, window_minutes: int = C.HOURLY_WINDOW_MINUTES) -> DataFrame:
    """Vehicles and mean speed per hour and camera, straight from events."""
    vehicles = aggregates.vehicle_means(clean_events(events), window_minutes)
    return aggregates.total_summary(vehicles, window_minutes)


def by_type(events: DataFrame, window_minutes: int = C.HOURLY_WINDOW_MINUTES) -> DataFrame:
    """Vehicles, mean speed and mean observations per hour, camera and type."""
    vehicles = aggregates.vehicle_level(clean_events(events), window_minutes)
    return aggregates.type_summary(vehicles, window_minutes)


@dataclass
class HourlyTables:
    """Where the two summaries are published."""

    totals: str
    by_type: str

    def publish(self, vehicles: DataFrame, writer: str, batch: int, stamp: Column) -> None:
        """Merge the summaries of complete vehicle rows. Repeating a batch changes nothing."""
        totals_, types = aggregates.total_summary(vehicles), aggregates.type_summary(vehicles)
        upsert_table(
            totals_.withColumn("created_at", stamp),
            self.totals,
            writer,
            batch,
            SUMMARY_KEY,
            day_of="window_start",
        )
        upsert_table(
            types.withColumn("created_at", stamp),
            self.by_type,
            writer,
            batch,
            TYPE_KEY,
            day_of="window_start",
        )


def run(
    events: DataFrame, tables: HourlyTables, run_id: str, as_of: datetime, stamp: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Publish whole hours of events and return the quality report of the last hour.

    The vehicle rows feed two summaries; they are written once to the shared folder instead of
    being computed twice.
    """
    stamp = F.current_timestamp().cast("timestamp_ntz") if stamp is None else stamp
    vehicles = written_out(aggregates.vehicle_level(clean_events(events)), "vehicles")
    tables.publish(vehicles, f"run {run_id}", 0, stamp)
    return aggregates.quality_report(read_table(events.sparkSession, tables.totals), as_of)
