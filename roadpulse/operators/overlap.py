"""Non-maximum suppression: of boxes that overlap too much only the most confident stays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse import constants as C
from roadpulse.functions.geometry import box_iou
from roadpulse.operators.windows import _long_tracks, _slice_of
from roadpulse.session import written_out

BOX = ["x1", "y1", "x2", "y2"]
BLOCK_BOXES = 50_000  # boxes of one group that are settled side by side


def suppress_overlaps(
    df: DataFrame,
    threshold: float = C.NMS_IOU,
    class_col: str | None = "class_id",
    box_id: str = "box_id",
    source: str = "source_id",
    frame: str = "frame",
    block_boxes: int = BLOCK_BOXES,
) -> DataFrame:
    """Greedy suppression per camera and frame, and per class unless ``class_col`` is None.

    Boxes are taken by falling confidence (ties: smaller id; a confidence that is null or not a number
    comes last); one is kept if no kept box of its group overlaps it with IoU above the threshold, which
    lies from 0 to 1. A box with a corner that is null or not finite, or without area, overlaps nothing
    and is kept. Null cameras, frames and classes are groups like any other.

    Boxes with equal corners are one box first. Pairs above the threshold meet in the cells of a grid whose
    width follows their size. A box is settled once all better ones that it overlaps are: kept if none of
    those is kept. Each round settles what follows within a block, a group or a strip of a large group,
    and writes the pairs still open; the next round's strips have other borders.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("the threshold must lie from 0 to 1")
    if threshold == 1:
        return df  # nothing overlaps by more than all of it
    group = [source, frame, *([class_col] if class_col else [])]
    rows = written_out(df.withColumn("_row", F.monotonically_increasing_id()), "boxes")
    finite = [F.coalesce(F.abs(F.col(c)) < F.lit(float("inf")), F.lit(False)) for c in BOX]
    # NaN is greater than infinity here, so it is not finite either.
    solid = finite[0] & finite[1] & finite[2] & finite[3] & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))
    falling = F.when(F.isnull("confidence") | F.isnan("confidence"), F.lit(float("inf"))).otherwise(F.lit(0.0) - F.col("confidence"))
    place = F.struct(falling.cast("double").alias("rank"), F.col(box_id).alias("id"), F.col("_row").alias("row"))
    named = [F.col(c).alias(f"g{i}") for i, c in enumerate(group)]
    corners = [F.col(c).cast("double").alias(c) for c in BOX]
    boxes = rows.where(solid).select(*named, *corners, place.alias("place"))
    # Of equal boxes all but the best go: what removes the best one removes them too.
    keys = [f"g{i}" for i in range(len(group))]
    best = written_out(boxes.groupBy(*keys, *BOX).agg(F.min("place").alias("place")), "best")
    pairs = written_out(_pairs(best, keys, threshold, block_boxes), "pairs")
    gone = _settled(pairs)
    stays = best.select(F.col("place.row").alias("_row")).join(gone, "_row", "left_anti")
    kept = rows.where(solid).join(stays, "_row", "left_semi").unionByName(rows.where(~solid))
    return kept.select(*df.columns)


def _cells(level: Column) -> Column:
    """The at most four cells of a level that a box touches; a cell is wider than any box of the level."""
    width = F.pow(F.lit(2.0), level + 1)

    def touched(low: str, high: str) -> tuple[Column, Column]:
        return F.floor(F.col(low) / width), F.floor(F.col(high) / width)

    (a, b), (c, d) = touched("x1", "x2"), touched("y1", "y2")
    listed = [
        F.when((a + i <= b) & (c + j <= d), F.struct((a + i).alias("cx"), (c + j).alias("cy"))) for i in (0, 1) for j in (0, 1)
    ]
    return F.array_compact(F.array(*listed))


def _pairs(best: DataFrame, keys: list[str], threshold: float, block_boxes: int) -> DataFrame:
    """(worse, better, place of the worse, blocks of the worse) of each pair of a group above the threshold."""
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    sized = best.withColumn("level", F.floor(F.log2(side)).cast("int"))
    if threshold > 0:
        # Sides of boxes that overlap so much differ by less than 1 / threshold.
        steps = F.lit(int(math.log2(1 / threshold)) + 1)
    else:
        ends = sized.agg(F.min("level").alias("a"), F.max("level").alias("z"))
        sized, steps = sized.crossJoin(F.broadcast(ends)), F.col("z") - F.col("level")
    shorter = int(block_boxes * 0.61) + 1
    large = not best.groupBy(*keys).count().where(F.col("count") > shorter).isEmpty()
    for name, boxes in (("a_block", block_boxes), ("b_block", shorter)):
        sized = _with_block(sized, keys, name, boxes) if large else sized.withColumn(name, F.xxhash64(*keys))
    kept = [*keys, *BOX, "place", "level", "a_block", "b_block"]
    home = sized.select(*kept, F.explode(_cells(F.col("level"))).alias("c")).select(*kept, "c.*").alias("h")
    probe = sized.select(*kept, F.explode(F.sequence(F.col("level"), F.col("level") + steps)).alias("at"))
    probe = probe.select(*kept, "at", F.explode(_cells(F.col("at"))).alias("c")).select(*kept, "at", "c.*").alias("p")
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"p.{k}")) for k in keys]
    same += [F.col("h.level") == F.col("p.at"), F.col("h.cx") == F.col("p.cx"), F.col("h.cy") == F.col("p.cy")]
    met = home.join(probe, same)
    # Boxes meet in several cells; the one with the corner of what they share counts.
    width = F.pow(F.lit(2.0), F.col("h.level") + 1)
    for axis, cell in (("x1", "cx"), ("y1", "cy")):
        met = met.where(F.floor(F.greatest(F.col(f"h.{axis}"), F.col(f"p.{axis}")) / width) == F.col(f"h.{cell}"))
    once = (F.col("p.level") < F.col("h.level")) | (F.col("p.place") < F.col("h.place"))
    h, p = ({c: F.col(f"{s}.{c}") for c in BOX} for s in ("h", "p"))
    met = met.where(once & (box_iou(h, p) > threshold))
    first = F.col("h.place") < F.col("p.place")

    def worse(name: str) -> Column:
        return F.when(first, F.col(f"p.{name}")).otherwise(F.col(f"h.{name}"))

    better = F.when(first, F.col("h.place.row")).otherwise(F.col("p.place.row"))
    return met.select(better.alias("better"), *[worse(c).alias(c) for c in ("place", "a_block", "b_block")])


def _with_block(sized: DataFrame, keys: list[str], name: str, boxes: int) -> DataFrame:
    """The rows with the block of each box: its group, and in a group of more boxes a strip along x."""
    cuts = F.broadcast(_long_tracks(sized.select(*keys, "x1"), sized.select(*keys), keys, "x1", boxes))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    strip = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(_slice_of(F.col("_cuts"), F.col("x1")))
    return sized.join(cuts, same, "left").select(*sized.columns, F.xxhash64(*keys, strip).alias(name))


def _settle(block: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What follows for the boxes of one block: rows with ``kept`` where a box can be settled."""
    order = pa.Table.from_batches(block).flatten()
    order = order.sort_by([(f"place.{name}", "ascending") for name in ("rank", "id", "row")])
    known: dict[int, bool | None] = {}
    betters: list[tuple[int, bool]] = []
    rows, better, still = (order[c].to_pylist() for c in ("place.row", "better", "open"))
    for i, row in enumerate(rows):
        betters.append((better[i], still[i]))
        if i + 1 < len(rows) and rows[i + 1] == row:
            continue
        # True: kept; False: gone; None: not yet known, as a better box lies in another block.
        found = [known.get(b) if waits else True for b, waits in betters]
        known[row] = False if True in found else None if None in found else True
        betters.clear()
    settled = [(r, k) for r, k in known.items() if k is not None]
    made = [pa.array([r for r, _ in settled], pa.int64()), pa.array([k for _, k in settled], pa.bool_())]
    yield pa.RecordBatch.from_arrays(made, names=["row", "kept"])


def _settled(pairs: DataFrame) -> DataFrame:
    """(_row) of the boxes that go. Every round settles the best open box of each group at least."""
    gone, number = None, 0
    while not pairs.isEmpty():
        waiting = pairs.select(F.col("place.row").alias("w")).distinct()
        marked = pairs.join(waiting, F.col("better") == F.col("w"), "left").withColumn("open", F.col("w").isNotNull())
        block = "a_block" if number % 2 == 0 else "b_block"
        solved = marked.select(F.col(block).alias("block"), "better", "place", "open").groupBy("block")
        round_ = written_out(solved.applyInArrow(_settle, "row bigint, kept boolean"), "settled")
        lost = round_.where(~F.col("kept")).select(F.col("row").alias("_row"))
        gone = lost if gone is None else gone.unionByName(lost)
        left = pairs.join(round_, F.col("place.row") == F.col("row"), "left_anti")
        left = left.join(lost, F.col("better") == F.col("_row"), "left_anti")
        pairs, number = written_out(left, "pairs"), number + 1
    return pairs.select(F.col("better").alias("_row")) if gone is None else gone
