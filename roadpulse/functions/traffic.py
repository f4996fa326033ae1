"""Labels, scores and rounding of traffic metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import constants as C


def rounded(value: Column, digits: int) -> Column:
    """Round half up, with a nudge so that binary ties such as 2.675 go up in every engine."""
    return F.round(value + F.lit(1e-9), digits)


def traffic_status(avg_speed: Column, total_count: Column) -> Column:
    """Traffic state of one camera window. The order of the rules matters."""
    return (
        F.when(total_count.isNull() | (total_count == 0) | avg_speed.isNull(), C.STATUS_EMPTY)
        .when(total_count <= C.FEW_VEHICLES, C.STATUS_FREE)
        .when(avg_speed < C.JAM_BELOW_KMH, C.STATUS_JAMMED)
        .when(avg_speed < C.DENSE_BELOW_KMH, C.STATUS_DENSE)
        .otherwise(C.STATUS_FREE)
    )


def _lookup(key: Column, table: dict, default: Column) -> Column:
    found = default
    for value, text in reversed(table.items()):
        found = F.when(key == F.lit(value), F.lit(text)).otherwise(found)
    return found


def class_name(class_id: Column) -> Column:
    """Vehicle type of a detector class, ``unknown`` for any other class."""
    return _lookup(class_id, C.VEHICLE_CLASSES, F.lit(C.UNKNOWN_TYPE))


def camera_label(source_id: Column) -> Column:
    return _lookup(source_id, C.CAMERA_LABELS, source_id)


def camera_place(source_id: Column) -> Column:
    return _lookup(source_id, C.CAMERA_PLACES, F.lit(C.DEFAULT_PLACE))


def plausible_speed(speed: Column, limit: float = C.MAX_PLAUSIBLE_KMH) -> Column:
    """The speed when it lies strictly between 0 and the limit, else null."""
    return F.when((speed > 0) & (speed < limit), speed)


def speed_norm(speed: Column, full_scale: float = C.HEAT_FULL_SCALE_KMH) -> Column:
    """Speed on a 0..1 heat scale."""
    return F.least(speed / F.lit(full_scale), F.lit(1.0))


def alert_severity(status: Column) -> Column:
    return F.when(status == C.STATUS_JAMMED, C.SEVERITY_HIGH).otherwise(C.SEVERITY_MEDIUM)


def alert_title(source_id: Column, status: Column) -> Column:
    return F.concat_ws(" ", source_id, F.lower(status))


def alert_time(last_update: Column) -> Column:
    return F.coalesce(F.date_format(last_update, "HH:mm"), F.lit(C.JUST_NOW))


def load_score(avg_speed: Column, vehicles: Column) -> Column:
    """Road load from 25 to 100: slow and full roads score high."""
    raw = F.lit(100.0) - avg_speed * F.lit(2.0) + vehicles / F.lit(2.0)
    return F.least(F.lit(100), F.greatest(F.lit(25), F.floor(raw + F.lit(0.5)).cast("int")))
