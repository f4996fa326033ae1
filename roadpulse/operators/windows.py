"""Trajectories: ordered, bounded look-back per tracked vehicle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions.traffic import class_name, plausible_speed, speed_norm

TRACK = ["source_id", "tracker_id"]

# Only so many over-long tracks are split, so that the table of them, which is broadcast, has a bound.
# Any other track holds less than a hundred-thousandth of all rows and is computed whole.
MAX_SPLIT_TRACKS = 100_000
ROWS_PER_SLICE = 1_000_000
# A long track is cut at quantiles of its rows; a slice then holds a thousandth of it at least.
_QUANTILES = 1024


def _long_tracks(df: DataFrame, sizes: DataFrame, keys: list[str], order: str, slice_rows: int) -> DataFrame:
    """The longest tracks with the places of ``order`` at which they are cut, about equal in rows."""
    named = [F.col(k).alias(f"_{k}") for k in keys]
    size = sizes.groupBy(*named).agg(F.count("*").alias("_n")).where(F.col("_n") > slice_rows)
    longest = F.broadcast(size.orderBy(F.desc("_n")).limit(MAX_SPLIT_TRACKS))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    fractions = [i / _QUANTILES for i in range(1, _QUANTILES)]
    spread = (
        df.join(longest, same_key)
        .groupBy(*[f"_{k}" for k in keys], "_n")
        .agg(F.percentile_approx(F.col(order).cast("double"), fractions, 100 * _QUANTILES).alias("_q"))
    )
    slices = F.least(F.ceil(F.col("_n") / slice_rows), F.lit(_QUANTILES)).cast("int")
    places = F.transform(
        F.sequence(F.lit(1), slices - 1), lambda i: F.get("_q", (i * _QUANTILES / slices).cast("int") - 1)
    )
    return spread.select(*[f"_{k}" for k in keys], F.array_distinct(places).alias("_cuts"))


def _slice_of(cuts: Column, value: Column) -> Column:
    """How many cuts lie below a value, by bisection."""
    steps = F.array(*[F.lit(_QUANTILES >> i) for i in range(1, _QUANTILES.bit_length())])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(F.get(cuts, found + step - 1) < value, found + step).otherwise(found),
    )


def over_recent_rows(
    df: DataFrame,
    compute: Callable[[DataFrame, list[str]], DataFrame],
    lookback: int,
    keys: list[str] | None = None,
    order: str = "frame",
    slice_rows: int = ROWS_PER_SLICE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Apply ``compute(rows, partition_columns)``, whose result depends on the row itself and
    the ``lookback`` rows before it within its key.

    A key with more than ``slice_rows`` rows is cut into slices along ``order`` that are computed
    side by side. The first rows of a slice lack predecessors there, so they are computed once
    more from the rows around the slice borders alone. Results are the same as without slices.

    ``sizes`` may be a cheaper table with at least the rows of each key, such as the scan from which
    ``df`` is filtered; its keys are counted instead of those of ``df``.
    """
    keys = keys or TRACK
    sizes = df if sizes is None else sizes
    long_tracks = F.broadcast(_long_tracks(df.select(*keys, order), sizes.select(*keys), keys, order, slice_rows))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]

    part = _slice_of(F.col("_cuts"), F.col(order).cast("double"))
    sliced = df.join(long_tracks, same_key, "left").select(
        *df.columns, F.when(F.col("_cuts").isNull(), F.lit(-1)).otherwise(part).alias("_slice")
    )
    # Every slice row is computed in its slice; only the heads of later slices are replaced.
    within = Window.partitionBy(*keys, "_slice").orderBy(order)
    position = F.row_number().over(within)
    whole = (
        compute(sliced.withColumn("_position", position), [*keys, "_slice"])
        .where((F.col("_slice") <= 0) | (F.col("_position") > lookback))
        .drop("_slice", "_position")
    )

    # Borders: the rows next to a cut, from long tracks only (usually there are none).
    long_rows = df.join(long_tracks, same_key, "inner").select(*df.columns, part.alias("_slice"))
    border = (
        long_rows.withColumn("_position", position)
        .withColumn("_last", F.lead(F.lit(1), lookback).over(within).isNull())
        .where(F.col("_last") | (F.col("_position") <= lookback))
        .drop("_last")
    )
    heads = (
        compute(border, keys)
        .where((F.col("_slice") > 0) & (F.col("_position") <= lookback))
        .drop("_slice", "_position")
    )
    return whole.unionByName(heads)


def _by_visit(part: DataFrame, keys: list[str], order: str, gap: str | None, time: str) -> tuple[DataFrame, list[str]]:
    """Rows with the visit they belong to, and the keys of a visit.

    A track that stays unseen for longer than ``gap`` is forgotten: what comes after is another visit.
    """
    if gap is None:
        return part, keys
    ordered = Window.partitionBy(*keys).orderBy(order)
    opens = F.col(time) > F.lag(time).over(ordered) + F.expr(f"interval {gap}")
    marked = part.withColumn("_opens", F.when(opens, F.row_number().over(ordered)))
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("_visit", F.coalesce(F.max("_opens").over(so_far), F.lit(0))), [*keys, "_visit"]


def per_second(fps: float | str) -> Column:
    """Frame rate of a row; ``fps`` is a number or the column that holds it (25 where it is null)."""
    if isinstance(fps, str):
        return F.coalesce(F.col(fps).cast("double"), F.lit(C.DEFAULT_FPS))
    return F.lit(float(fps))


def _trailing(keys: list[str], order: str, rows: int):
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)


def endpoint_speed(
    df: DataFrame,
    fps: float | str = C.DEFAULT_FPS,
    x: str = "mx",
    y: str = "my",
    order: str = "frame",
    rates: list[float] | None = None,
    first: str | None = None,
    gap: str | None = None,
    time: str = "ts",
    **sliced,
) -> DataFrame:
    """Speed from the first to the last of the most recent int(fps) points.

    Adds ``points`` (trajectory length) and ``speed_kmh``. Time is points / fps, one step more
    than lies between the points; that is how published speeds are defined. ``fps`` may name a column
    that is constant in a track; ``rates`` then lists its values (all whole rates up to 60 if not given).

    ``first`` names a column that is replaced by its value in the track's first row. With ``gap`` a track
    unseen for longer starts anew.
    """
    if isinstance(fps, str):
        kept = sorted({max(int(r), 1) for r in rates or range(1, C.MAX_FPS + 1)} | {int(C.DEFAULT_FPS)})
    else:
        kept = [max(int(fps), 1)]

    def compute(part: DataFrame, keys: list[str]) -> DataFrame:
        part, own = _by_visit(part, keys, order, gap, time)
        ordered = Window.partitionBy(*own).orderBy(order)
        so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
        rate = per_second(fps)
        rows = F.greatest(F.floor(rate), F.lit(1)).cast("bigint")
        number = F.row_number().over(ordered).cast("bigint")

        def oldest(column: str) -> Column:
            value = F.first(column).over(so_far)
            for r in kept:
                full = (rows == r) & (number >= r)
                value = F.when(full, F.lag(column, r - 1).over(ordered)).otherwise(value)
            return value

        moved = F.hypot(F.col(x) - oldest(x), F.col(y) - oldest(y))
        added = {"points": F.least(number, rows), "_moved": moved}
        if first:
            added[first] = F.first(first).over(so_far)
        speed = F.col("_moved") / (F.col("points") / rate) * F.lit(3.6)
        return part.withColumns(added).withColumn("speed_kmh", speed).drop("_moved", "_opens", "_visit")

    if first and gap is not None:
        df, first = with_first_of_visit(df, first, gap, order, time, **sliced), None
    if not first:
        return over_recent_rows(df, compute, kept[-1] - 1 + (1 if gap else 0), order=order, **sliced)
    return _with_first_of_long_tracks(df, compute, kept[-1] - 1, order, first, **sliced)


def _with_first_of_long_tracks(df, compute, lookback, order, first, slice_rows=ROWS_PER_SLICE, sizes=None):
    """``over_recent_rows`` for a result that also holds the first value of the whole track.

    Slices do not see the first row of their track, so the value is joined to the long tracks alone.
    """
    done = over_recent_rows(df, compute, lookback, order=order, slice_rows=slice_rows, sizes=sizes)
    size = (df if sizes is None else sizes).groupBy(*[F.col(k).alias(f"_{k}") for k in TRACK])
    size = size.agg(F.count("*").alias("_n")).where(F.col("_n") > slice_rows)
    longest = F.broadcast(size.orderBy(F.desc("_n")).limit(MAX_SPLIT_TRACKS))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in TRACK]
    firsts = df.join(longest, same_key).groupBy(*[f"_{k}" for k in TRACK]).agg(F.min_by(first, order).alias("_first"))
    joined = done.join(F.broadcast(firsts), same_key, "left")
    whole = F.when(F.col(f"_{TRACK[1]}").isNotNull(), F.col("_first")).otherwise(F.col(first))
    return joined.select(*[whole.alias(c) if c == first else F.col(c) for c in done.columns])


def with_first_of_visit(
    df: DataFrame,
    column: str,
    gap: str,
    order: str = "frame",
    time: str = "ts",
    slice_rows: int = ROWS_PER_SLICE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The rows with ``column`` replaced by its value in the first row of their visit.

    A track unseen for longer than ``gap`` starts another visit. Whether a row starts one depends on the row
    before it alone. A long track is cut as in ``over_recent_rows``; each slice then hands the value of its
    last start on to the slices after it, of which a track has at most a thousand.
    """
    sizes = df if sizes is None else sizes

    def starts(part: DataFrame, keys: list[str]) -> DataFrame:
        ordered = Window.partitionBy(*keys).orderBy(order)
        opens = F.col(time) > F.lag(time).over(ordered) + F.expr(f"interval {gap}")
        opens = F.coalesce(opens, F.lit(False)) | (F.row_number().over(ordered) == 1)
        return part.withColumn("_start", F.when(opens, F.struct(F.col(column).alias("value"))))

    marked = over_recent_rows(df, starts, 1, order=order, slice_rows=slice_rows, sizes=sizes)
    cuts = F.broadcast(_long_tracks(df.select(*TRACK, order), sizes.select(*TRACK), TRACK, order, slice_rows))
    same_key = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in TRACK]
    part = _slice_of(F.col("_cuts"), F.col(order).cast("double"))
    sliced = marked.join(cuts, same_key, "left").select(
        *marked.columns, F.when(F.col("_cuts").isNull(), F.lit(-1)).otherwise(part).alias("_slice")
    )
    # Only slices of long tracks have a number from 0 on; each is one row here.
    place = F.when(F.col("_start").isNotNull(), F.col(order))
    ends = sliced.where(F.col("_slice") >= 0).groupBy(*[F.col(k).alias(f"_{k}") for k in TRACK], F.col("_slice").alias("_at"))
    ends = ends.agg(F.max_by("_start", place).alias("_end"))
    earlier = Window.partitionBy(*[f"_{k}" for k in TRACK]).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.withColumn("_handed", F.last("_end", ignorenulls=True).over(earlier)).drop("_end")
    joined = sliced.join(handed, [*same_key, F.col("_slice") == F.col("_at")], "left")
    so_far = Window.partitionBy(*TRACK, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    latest = F.coalesce(F.last("_start", ignorenulls=True).over(so_far), F.col("_handed"))["value"]
    return joined.withColumn("_value", latest).select(*[F.col("_value").alias(c) if c == column else F.col(c) for c in df.columns])


def _path_columns(
    part: DataFrame, keys: list[str], x: str, y: str, order: str, points: int, fps: float | str
) -> DataFrame:
    # Sums run over the rows of the frame itself, so an outlier or a NaN leaves with its row.
    ordered = Window.partitionBy(*keys).orderBy(order)
    step = F.hypot(F.col(x) - F.lag(x).over(ordered), F.col(y) - F.lag(y).over(ordered))
    n = F.least(F.row_number().over(ordered).cast("bigint"), F.lit(points))
    length = F.sum("_step").over(_trailing(keys, order, points - 1))
    speed = length / (F.col("points") / per_second(fps)) * F.lit(3.6)
    return (
        part.withColumns({"points": n, "_step": F.coalesce(step, F.lit(0.0))})
        .withColumn("path_speed_kmh", F.when(F.col("points") >= 3, speed))
        .drop("_step")
    )


def path_speed(
    df: DataFrame,
    fps: float | str = C.DEFAULT_FPS,
    x: str = "mx",
    y: str = "my",
    order: str = "frame",
    points: int = C.PATH_POINTS,
    gap: str | None = None,
    time: str = "ts",
    **sliced,
) -> DataFrame:
    """Speed along the path of the last 30 points; null below three points.

    Adds ``points`` and ``path_speed_kmh``. With ``gap`` a track unseen for longer starts anew.
    """

    def compute(part: DataFrame, keys: list[str]) -> DataFrame:
        part, own = _by_visit(part, keys, order, gap, time)
        return _path_columns(part, own, x, y, order, points, fps).drop("_opens", "_visit")

    return over_recent_rows(df, compute, points, order=order, **sliced)


def smooth_speed(
    df: DataFrame,
    fps: float | str = C.DEFAULT_FPS,
    x: str = "mx",
    y: str = "my",
    order: str = "frame",
    points: int = C.PATH_POINTS,
    last: int = C.SMOOTH_SPEEDS,
    at_least: int = C.SMOOTH_MIN_SPEEDS,
    gap: str | None = None,
    time: str = "ts",
    **sliced,
) -> DataFrame:
    """``path_speed`` plus ``smooth_speed_kmh``: the mean of the last 10 path speeds once there
    are 3 of them, before that the path speed itself."""

    def compute(part: DataFrame, keys: list[str]) -> DataFrame:
        part, own = _by_visit(part, keys, order, gap, time)
        recent = _trailing(own, order, last)
        raw = F.col("path_speed_kmh")
        # The first two rows of a track have no speed yet; a mean leaves them out.
        mean, n = F.avg(raw).over(recent), F.count(raw).over(recent)
        return (
            _path_columns(part, own, x, y, order, points, fps)
            .withColumns({"_mean": mean, "_n": n})
            .withColumn("smooth_speed_kmh", F.when(F.col("_n") >= at_least, F.col("_mean")).otherwise(raw))
            .drop("_mean", "_n", "_opens", "_visit")
        )

    return over_recent_rows(df, compute, points + last - 1, order=order, **sliced)


def trajectory_array(
    df: DataFrame,
    x: str = "mx",
    y: str = "my",
    order: str = "frame",
    points: int = C.PATH_POINTS,
    gap: str | None = None,
    time: str = "ts",
    **sliced,
) -> DataFrame:
    """Add ``trajectory``: the recent points of the track, oldest first."""

    def compute(part: DataFrame, keys: list[str]) -> DataFrame:
        part, own = _by_visit(part, keys, order, gap, time)
        point = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
        w = _trailing(own, order, points)
        return part.withColumn("trajectory", F.collect_list(point).over(w)).drop("_opens", "_visit")

    return over_recent_rows(df, compute, points, order=order, **sliced)


def smooth_boxes(
    df: DataFrame,
    order: str = "frame",
    frames: int = C.SMOOTH_BOXES,
    columns: tuple[str, ...] = ("x1", "y1", "x2", "y2"),
    **sliced,
) -> DataFrame:
    """Replace box corners by their mean over the track's recent boxes."""

    def compute(part: DataFrame, keys: list[str]) -> DataFrame:
        w = _trailing(keys, order, frames)
        return part.withColumns({c: F.avg(c).over(w) for c in columns})

    return over_recent_rows(df, compute, frames - 1, order=order, **sliced)


def first_class(df: DataFrame, order: str = "frame") -> DataFrame:
    """Per track the class it was first seen with, which it keeps for life."""
    return df.groupBy(*TRACK).agg(F.min_by("class_id", order).alias("class_id"))


def with_first_class(df: DataFrame, order: str = "frame") -> DataFrame:
    """Replace each row's class by the first class of its track.

    A reduced table is joined back instead of an unbounded window, so a very long track can be
    split by the adaptive skew join. Where the rows go through ``endpoint_speed`` anyway, its
    ``first`` does the same in the window that is there.
    """
    return df.drop("class_id").join(first_class(df, order), TRACK)


def last_seen(df: DataFrame, order: str = "frame", x: str = "mx", y: str = "my") -> DataFrame:
    """Per track the latest class, type and position."""

    def latest(column: str) -> Column:
        return F.max_by(column, order)

    return df.groupBy(*TRACK).agg(
        F.max(order).alias(order),
        latest("class_id").alias("class_id"),
        class_name(latest("class_id")).alias("vehicle_type"),
        latest(x).alias(x),
        latest(y).alias(y),
    )


def heat_points(
    df: DataFrame, order: str = "frame", x: str = "mx", y: str = "my", speed: str = "speed_kmh"
) -> DataFrame:
    """Per track the last position with its speed on a 0..1 scale; implausible speeds drop out."""
    last = df.groupBy(*TRACK).agg(
        F.max_by(x, order).alias(x),
        F.max_by(y, order).alias(y),
        F.max_by(speed, order).alias(speed),
    )
    return last.where(plausible_speed(F.col(speed)).isNotNull()).withColumn(
        "heat", speed_norm(F.col(speed))
    )


def track_sessions(df: DataFrame, gap: str = C.TRACK_TIMEOUT, time: str = "ts") -> DataFrame:
    """Visits of a track: it is forgotten after ``gap`` unseen. Works on batches and streams."""
    return (
        df.groupBy(*TRACK, F.session_window(time, gap).alias("w"))
        .agg(F.count("*").alias("observations"), F.avg("speed_kmh").alias("avg_speed"))
        .select(
            *TRACK,
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "observations",
            "avg_speed",
        )
    )
