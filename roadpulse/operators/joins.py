"""Lookups, merges and comparisons of keyed tables."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.cameras import TO_METRES, TO_PIXELS, matrix, with_projection
from roadpulse.functions.geometry import project

SNAPSHOT_FIELDS = ["total_vehicles", "avg_speed", "max_speed", "traffic_status", "last_update"]


def with_camera(df: DataFrame, cameras: DataFrame) -> DataFrame:
    """Attach the settings of each row's own camera. Unknown cameras drop out."""
    return df.join(cameras, "source_id", "inner")


def to_metres(
    df: DataFrame, cameras: DataFrame, x: str = "px", y: str = "py", minus_one: bool = True
) -> DataFrame:
    """Add ``mx``, ``my``: the point on the road plane in metres."""
    dimension = with_projection(cameras, minus_one).select("source_id", *TO_METRES)
    joined = with_camera(df, dimension)
    mx, my = project(matrix(TO_METRES), F.col(x), F.col(y))
    return joined.withColumns({"mx": mx, "my": my}).drop(*TO_METRES)


def to_pixels(
    df: DataFrame, cameras: DataFrame, x: str = "mx", y: str = "my", minus_one: bool = True
) -> DataFrame:
    """Add ``ix``, ``iy``: the frame pixel of a point on the road plane."""
    dimension = with_projection(cameras, minus_one).select("source_id", *TO_PIXELS)
    joined = with_camera(df, dimension)
    ix, iy = project(matrix(TO_PIXELS), F.col(x), F.col(y))
    return joined.withColumns({"ix": ix, "iy": iy}).drop(*TO_PIXELS)


def upsert_rows(
    stored: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    keep: tuple[str, ...] = ("created_at",),
    newest: str | None = None,
) -> DataFrame:
    """Stored rows with incoming rows merged over them by key.

    Incoming values win, nulls included, except for the ``keep`` columns of rows that already
    exist. With ``newest`` an incoming row wins only if it is not older than the stored one.
    Both sides must be unique by key.
    """
    ours = stored.select("*", F.lit(True).alias("_held")).alias("s")
    theirs = incoming.select("*", F.lit(True).alias("_new")).alias("i")
    on = reduce(and_, [F.col(f"s.{k}") == F.col(f"i.{k}") for k in keys])
    wins = F.col("i._new").isNotNull()
    if newest is not None:
        wins &= F.col("s._held").isNull() | (F.col(f"i.{newest}") >= F.col(f"s.{newest}"))

    def merged(name: str):
        old, new = F.col(f"s.{name}"), F.col(f"i.{name}")
        if name in keys:
            return F.coalesce(old, new).alias(name)
        if name in keep:
            return F.when(F.col("s._held"), old).otherwise(new).alias(name)
        return F.when(wins, new).otherwise(old).alias(name)

    return ours.join(theirs, on, "full_outer").select(*[merged(c) for c in stored.columns])


def roster_default(
    snapshot: DataFrame, roster: DataFrame, all_or_nothing: bool = False
) -> DataFrame:
    """One row per rostered camera; cameras without a snapshot wait with zero metrics.

    ``all_or_nothing`` fills in only when there is no snapshot at all, otherwise just the
    snapshot is shown.
    """
    waiting = {
        "total_vehicles": F.lit(0),
        "avg_speed": F.lit(0.0),
        "max_speed": F.lit(0.0),
        "traffic_status": F.lit(C.STATUS_WAITING),
    }
    if all_or_nothing:
        filled = roster.where(~snapshot.exists()).select(
            "source_id",
            *[value.alias(name) for name, value in waiting.items()],
            F.lit(None).cast(snapshot.schema["last_update"].dataType).alias("last_update"),
        )
        return snapshot.select("source_id", *waiting, "last_update").unionByName(filled)
    joined = roster.select("source_id").join(snapshot, "source_id", "left")
    return joined.select(
        "source_id",
        *[F.coalesce(F.col(name), value).alias(name) for name, value in waiting.items()],
        "last_update",
    )


def snapshot_changes(
    before: DataFrame, after: DataFrame, fields: list[str] | None = None
) -> DataFrame:
    """Per camera whether any shown field differs from the previous snapshot.

    Rows that appear or vanish count as changed.
    """
    fields = fields or SNAPSHOT_FIELDS
    old = before.select("source_id", *fields, F.lit(True).alias("_in")).alias("o")
    new = after.select("source_id", *fields, F.lit(True).alias("_in")).alias("n")
    joined = old.join(new, F.col("o.source_id") == F.col("n.source_id"), "full_outer")
    differs = reduce(
        or_, [~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*fields, "_in"]]
    )
    return joined.select(
        F.coalesce("o.source_id", "n.source_id").alias("source_id"), differs.alias("changed")
    )
