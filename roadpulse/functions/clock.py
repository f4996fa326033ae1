"""Event time: parsing, window floors, local days."""

from __future__ import annotations

from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse import constants as C


def parse_time(text: Column, fmt: str = C.TIME_FORMAT) -> Column:
    """Wall-clock time without a zone; null when the text does not parse."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


# A time of day with an optional fraction and an optional offset from UTC.
_TIMES = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:?\d{2})?$"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})$"


def parse_local_time(text: Column, zone: str = C.ZONE) -> Column:
    """Wall-clock time in ``zone`` of a text with a space or a T, a fraction and an offset, as they come.

    A text without an offset is local already; with one, or Z, it is converted. Null when the text does
    not parse. The session's zone plays no part.
    """
    offset = F.regexp_extract(text, r"[ T].*?" + _OFFSET, 1)
    plain = F.regexp_replace(text, _OFFSET, "").try_cast("timestamp_ntz")
    hours = F.substring(offset, 2, 2).try_cast("int")
    minutes_ = hours * 60 + F.regexp_extract(offset, r"(\d{2})$", 1).try_cast("int")
    east = F.when(F.startswith(offset, F.lit("-")), -minutes_).otherwise(minutes_)
    utc = plain - F.make_dt_interval(mins=F.when(offset == "Z", F.lit(0)).otherwise(east))
    local = F.when(offset == "", plain).otherwise(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))
    # Most texts have neither fraction nor offset, which their length tells; the rest is not worked out for these.
    found = F.when(F.length(text) == 19, text.try_cast("timestamp_ntz")).otherwise(local)
    return F.when(F.regexp_like(text, F.lit(_TIMES)), found)


_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_instant(wall_clock: Column) -> Column:
    """A zone-less time as the instant that reads the same in UTC. Streams need one for watermarks.

    Windows over it start at whole hours of the wall clock in every session zone, and no hour is
    missing or doubled where clocks change.
    """
    # Parts of the time itself: a difference of two times would go through the session's zone.
    seconds = F.unix_date(F.to_date(wall_clock)).cast("bigint") * 86_400
    seconds += F.hour(wall_clock) * 3_600 + F.minute(wall_clock) * 60
    micros = F.extract(F.lit("SECOND"), wall_clock) * 1_000_000
    return F.timestamp_micros(seconds * 1_000_000 + micros.cast("bigint"))


def as_wall_clock(instant: Column) -> Column:
    """The inverse of ``as_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))


def local_time(instant: Column, source_zone: str | None = None, zone: str = C.ZONE) -> Column:
    """Wall-clock time in ``zone``: naive values are taken as local, others are converted."""
    if source_zone is None:
        return instant.cast("timestamp_ntz")
    return F.convert_timezone(F.lit(source_zone), F.lit(zone), instant.cast("timestamp_ntz"))


def window_start(ts: Column, size: str) -> Column:
    """Start of the tumbling window that holds ``ts``. Keeps zone-less timestamps zone-less."""
    return F.window(ts, size)["start"]


def minutes(n: int) -> str:
    return f"{n} minutes"


def local_day_bounds(as_of: datetime, zone: str = C.ZONE) -> tuple[datetime, datetime]:
    """[midnight, next midnight) of the local day that holds ``as_of``, as wall-clock times.

    A naive ``as_of`` is local already; an aware one is converted to the zone first.
    """
    local = as_of if as_of.tzinfo is None else as_of.astimezone(ZoneInfo(zone))
    start = datetime(local.year, local.month, local.day)
    return start, start + timedelta(days=1)


def ntz(value: datetime) -> Column:
    """Zone-less timestamp literal."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def text_time(ts: Column) -> Column:
    return F.date_format(ts, C.TIME_FORMAT)


def clock_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def iso_utc(ts: Column, zone: str = C.ZONE) -> Column:
    """ISO-8601 UTC text with milliseconds of a wall-clock time in ``zone``."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
