"""Per-vehicle state on a stream: trajectory speed, running visits, and visits as sessions.

State lives in the stream's state store, keyed by track; a batch reads and writes the tracks it has rows of,
and no others. The rows of one track in one batch are held together, so a stream's record limit bounds them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from roadpulse import constants as C
from roadpulse.operators import windows
from roadpulse.operators.windows import TRACK, track_sessions

# Spark starts a worker beside the driver that may not have this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPEEDS = "source_id string, tracker_id int, frame int, mx double, my double, points bigint, speed_kmh double"
VISITS = (
    "source_id string, tracker_id int, frame int, micros bigint, visit_micros bigint, observations bigint, "
    "avg_speed double, closed boolean"
)


class SpeedOfTracks(StatefulProcessor):
    """The last int(fps) points of every track, by frame, and the speed of each new point.

    A point that arrives after later frames of its track takes its place among the points that are kept;
    speeds that are out already stay as they are. With ``forget`` a timer in event time removes a track's
    points when the watermark is that much past its last one.
    """

    def __init__(self, forget_micros: int | None = None) -> None:
        self.forget = forget_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.points = handle.getListState("points", "frame int, mx double, my double")
        if self.forget is not None:
            self.seen = handle.getValueState("seen", "timer bigint")

    def _set_timer(self, latest: int) -> None:
        timer = (latest + self.forget) // 1000 + 1
        if self.seen.exists():
            old = self.seen.get()[0]
            self.handle.deleteTimer(old)
            timer = max(timer, old)
        self.seen.update((timer,))
        self.handle.registerTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.seen.exists() and self.seen.get()[0] <= expiredTimerInfo.getExpiryTimeInMs():
            self.points.clear()
            self.seen.clear()
        return iter(())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values("frame", kind="stable")
        fps = float(new["fps"].iloc[0])
        length = max(int(fps), 1)
        kept = [tuple(p) for p in self.points.get()] if self.points.exists() else []
        frame, x, y = (
            np.concatenate([np.array([p[i] for p in kept], dtype=kind), new[c].to_numpy(kind)])
            for i, (c, kind) in enumerate((("frame", np.int64), ("mx", np.float64), ("my", np.float64)))
        )
        order = np.argsort(frame, kind="stable")
        is_new, frame, x, y = order >= len(kept), frame[order], x[order], y[order]
        number = np.arange(len(order))
        points = np.minimum(number + 1, length)
        oldest = number + 1 - points
        speed = np.hypot(x - x[oldest], y - y[oldest]) / (points / fps) * 3.6
        if self.forget is not None:
            self._set_timer(int(new["micros"].max()))
        last = slice(max(len(order) - length, 0), None)
        self.points.put(list(zip(frame[last].tolist(), x[last].tolist(), y[last].tolist())))
        made = {"frame": frame, "mx": x, "my": y, "points": points, "speed_kmh": speed}
        out = pd.DataFrame({c: values[is_new] for c, values in made.items()})
        out.insert(0, "source_id", key[0])
        out.insert(1, "tracker_id", pd.array([key[1]] * len(out), dtype="Int32"))
        yield out

    def close(self) -> None:
        pass


def track_speeds(
    points: DataFrame,
    fps: float | str = C.DEFAULT_FPS,
    forget: str | None = None,
    time: str = "ts",
    watermark: str = C.TRACK_TIMEOUT,
) -> DataFrame:
    """Speed of every point of a stream with ``mx``, ``my`` and ``frame``; see ``SpeedOfTracks``.

    ``fps`` is a number or the column that holds the rate of the camera. With ``forget``, such as
    "1 hour", a track leaves the state that long after its last ``time``, and rows later than ``watermark``
    are dropped; without it tracks stay for ever and no time is read.
    """
    columns = [*TRACK, "frame", "mx", "my", windows.per_second(fps).alias("fps")]
    if forget is None:
        rows = points.select(*columns)
        return rows.groupBy(*TRACK).transformWithStateInPandas(SpeedOfTracks(), SPEEDS, "Append", "None")
    known = points.where(F.col(time).isNotNull()).withWatermark(time, watermark)
    rows = known.select(*columns, F.unix_micros(F.col(time)).alias("micros"), time)
    return rows.groupBy(*TRACK).transformWithStateInPandas(SpeedOfTracks(_micros(forget)), SPEEDS, "Append", "EventTime")


def _micros(duration: str) -> int:
    return int(pd.Timedelta(duration).total_seconds() * 1_000_000)


def start_track_speed(
    points: DataFrame,
    table: str,
    checkpoint: str,
    fps: float | str = C.DEFAULT_FPS,
    trigger: dict | None = None,
    **forgetting: str,
) -> StreamingQuery:
    """Publish the speed of every point; the file sink's log holds each batch once."""
    return (
        track_speeds(points, fps, **forgetting)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


class RunningVisits(StatefulProcessor):
    """Observations and mean speed of every track's visit so far; the visit closes after ``gap`` unseen.

    State is one row per track on view: begin and end of its visit, observations, sum of speeds. A timer
    in event time closes the visit when the watermark passes its end; the row then leaves the state.
    """

    def __init__(self, gap_micros: int) -> None:
        self.gap = gap_micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.visit = handle.getValueState("visit", "first bigint, last bigint, n bigint, total double")

    def _timer(self, last: int) -> int:
        return (last + self.gap) // 1000 + 1

    def _frame(self, key, frame, micros, first, n, total, closed) -> pd.DataFrame:
        count = len(micros)
        unknown = np.isnan(frame)
        return pd.DataFrame(
            {
                "source_id": [key[0]] * count,
                "tracker_id": pd.array([key[1]] * count, dtype="Int32"),
                "frame": pd.arrays.IntegerArray(np.where(unknown, 0, frame).astype(np.int32), unknown),
                "micros": micros,
                "visit_micros": first,
                "observations": n,
                "avg_speed": total / n,
                "closed": closed,
            },
            copy=False,
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        new = parts[0] if len(parts) == 1 else pd.concat(parts)
        frame = new["frame"].to_numpy(np.float64, na_value=np.nan)
        micros, speed = new["micros"].to_numpy(np.int64), new["speed_kmh"].to_numpy(np.float64)
        order = np.lexsort((frame, micros))
        frame, micros, speed = frame[order], micros[order], speed[order]
        open_ = self.visit.get()
        if open_ is not None:
            self.handle.deleteTimer(self._timer(open_[1]))
        # The latest time seen up to each row; a row that comes late belongs to the visit that is open.
        before = micros[0] - self.gap - 1 if open_ is None else open_[1]
        seen = np.maximum.accumulate(np.concatenate([[before], micros]))
        opens = micros - seen[:-1] > self.gap
        visit = np.cumsum(opens)
        starts = np.concatenate([[0], np.flatnonzero(opens)]) if visit[0] == 0 else np.flatnonzero(opens)
        of_row = np.searchsorted(starts, np.arange(len(micros)), side="right") - 1
        carried = open_ is not None and visit[0] == 0
        base_n = np.where((of_row == 0) & carried, open_[2] if carried else 0, 0)
        sums = np.cumsum(speed)
        before_visit = np.concatenate([[0.0], sums])[starts]
        n = base_n + np.arange(len(micros)) - starts[of_row] + 1
        total = sums - before_visit[of_row] + np.where((of_row == 0) & carried, open_[3] if carried else 0.0, 0.0)
        first = micros[starts].copy()
        if carried:
            first[0] = min(first[0], open_[0])
        # Visits that are over by now: the one kept open, if the first row starts another, and all but the last.
        ends = starts[1:] - 1
        past = [] if open_ is None or carried else [open_]
        over = [np.array([p[i] for p in past], kind) for i, kind in enumerate((np.int64, np.int64, np.int64, np.float64))]
        over = [np.concatenate(c) for c in zip(over, (first[:-1], seen[ends + 1], n[ends], total[ends]))]
        closed = len(over[0])
        # One frame for all rows of the key; a frame of its own costs as much as hundreds of rows.
        yield self._frame(
            key,
            np.concatenate([frame, np.full(closed, np.nan)]),
            np.concatenate([micros, over[1] + self.gap]),
            np.concatenate([first[of_row], over[0]]),
            np.concatenate([n, over[2]]),
            np.concatenate([total, over[3]]),
            np.arange(len(micros) + closed) >= len(micros),
        )
        state = (int(first[-1]), int(seen[-1]), int(n[-1]), float(total[-1]))
        self.visit.update(state)
        self.handle.registerTimer(self._timer(state[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        visit = self.visit.get()
        if visit is not None and self._timer(visit[1]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.visit.clear()
            first, last, n, total = (np.array([v]) for v in visit)
            yield self._frame(key, np.array([np.nan]), last + self.gap, first, n, total, np.array([True]))

    def close(self) -> None:
        pass


def running_visits(
    points: DataFrame, gap: str = C.TRACK_TIMEOUT, watermark: str = C.TRACK_TIMEOUT, time: str = "ts"
) -> DataFrame:
    """A row per point with its visit so far, and a row (``closed``) per visit that has ended.

    ``points`` is a stream with ``frame``, ``speed_kmh`` and the timestamp ``time``. ``seen`` is the time of the
    point, or for a closed visit its last point's time plus ``gap``; ``visit_start`` is the visit's first.
    A point later than ``gap`` after the one before it starts another visit. Points with a null speed or time
    are not observations.
    """
    known = points.where(F.col("speed_kmh").isNotNull() & F.col(time).isNotNull()).withWatermark(time, watermark)
    rows = known.select(*TRACK, F.col("frame").cast("int").alias("frame"), F.unix_micros(F.col(time)).alias("micros"), "speed_kmh", time)
    visits = rows.groupBy(*TRACK).transformWithStateInPandas(RunningVisits(_micros(gap)), VISITS, "Append", "EventTime")
    return visits.select(
        *TRACK,
        "frame",
        F.timestamp_micros("micros").alias("seen"),
        F.timestamp_micros("visit_micros").alias("visit_start"),
        "observations",
        "avg_speed",
        "closed",
    )


def session_stream(
    points: DataFrame, gap: str = C.TRACK_TIMEOUT, watermark: str = C.TRACK_TIMEOUT, time: str = "ts"
) -> DataFrame:
    """Visits of tracks: a track that stays unseen for ``gap`` is closed and leaves the state."""
    return track_sessions(points.withWatermark(time, watermark), gap, time)
