"""Prefix trie of conversations by a splitter skeleton.

A conversation is the path of its turns, each turn a 16-byte digest of role and text. Equal paths become
one row first. A small sample of paths gives splitters, each cut to the shortest prefix that tells it from
its neighbour; the trie of their proper prefixes is the skeleton, which is broadcast, its size checked. Every
shard holds the paths between two splitters, sorted. Only a prefix of a splitter can have members in two
shards, so a shard finishes all other nodes by itself, and hands on one partial aggregate per skeleton node.
These are added per node, and then from the bottom of the skeleton up. The sample only balances shards; it
changes no result.

Turns are ordered by ``turn``, null first; ties by role, then by the digest of role and text, and rows that
repeat count each. Null roles and texts become empty, empty ones are turns like any other. Rows without a
conv_id belong to no conversation. The turns of one conversation meet in one row, as digests and lengths
(about 24 bytes a turn); texts are not shuffled. No rows give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.session import written_out

TOKEN = 16  # bytes of a turn's digest
SHARD_BYTES = 4 << 20  # of paths in a shard
MOST_SHARDS = 1 << 16  # beyond SHARD_BYTES * MOST_SHARDS of paths, shards grow
SAMPLE_PER_SHARD = 64
SAMPLE_BYTES = 16 << 20  # of sampled paths on the driver
SKELETON_BYTES = 8 << 20  # of splitters in the broadcast; with more, neighbouring shards become one
LONGEST = 4_096  # turns of a sampled path
IDS_PER_PIECE = 1 << 16

NODE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, `end` binary"


def turn_token(role: Column, text: Column) -> Column:
    """Digest of a turn, in hexadecimal."""
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.sha2(named, 256), 1, 2 * TOKEN)


def conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order as (token, chars).

    ``turns`` has conv_id, turn, role and text; its other columns are not read.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            role.alias("role"),
            turn_token(role, text).alias("token"),
            F.length(text).cast("bigint").alias("chars"),
        ).alias("t"),
    )
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda t: F.struct(t["token"], t["chars"])).alias("turns"))


def with_shared_heads(convs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """The conversations, each with its first turns taken from the first conversation of its group.

    Conversation c keeps its turns after the first h = crc32(decimal c) % ``most``; before them stand the
    first h turns of conversation c - c % ``group``, or as many as it has.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = convs.where(F.col("conv_id") == base).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = convs.join(heads, base == F.col("base"), "left").withColumn("h", h)
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), none)
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


def with_paths(convs: DataFrame) -> DataFrame:
    """(conv_id, path, end, chars): the turns as one binary string, its own digest, and the texts' lengths.

    Written to the shared folder.
    """
    path = F.unhex(F.array_join(F.col("turns.token"), ""))
    rows = convs.select("conv_id", path.alias("path"), F.col("turns.chars").alias("chars"))
    end = F.unhex(F.substring(F.sha2("path", 256), 1, 32))
    return written_out(rows.select("conv_id", "path", end.alias("end"), "chars"), "paths")


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    most = min(len(a), len(b)) // TOKEN
    if a[: most * TOKEN] == b[: most * TOKEN]:
        return most
    low, high = 0, most  # the first `low` turns are equal, the first `high` are not
    while high - low > 1:
        middle = (low + high) // 2
        if a[: middle * TOKEN] == b[: middle * TOKEN]:
            low = middle
        else:
            high = middle
    return low


def splitters_of(sample: Iterable[bytes], shards: int) -> list[bytes]:
    """Ascending splitters that part the sampled paths into shards of about equal size.

    Each is the shortest prefix of a sampled path that is greater than the path before it.
    """
    paths = sorted(set(sample))
    reach = np.cumsum([len(p) + TOKEN for p in paths])
    if not len(reach):
        return []
    places = np.searchsorted(reach, reach[-1] * np.arange(1, shards) / shards)
    found = []
    for i in sorted({int(x) for x in places if x}):
        found.append(paths[i][: (_common(paths[i - 1], paths[i]) + 1) * TOKEN])
    while sum(map(len, found)) > SKELETON_BYTES:
        found = found[::2]
    return found


def skeleton_of(splitters: Iterable[bytes]) -> dict[tuple[int, bytes], int]:
    """Numbers of the skeleton's nodes by (number of the parent, turn); the root is 0, a child has a larger one."""
    numbers: dict[tuple[int, bytes], int] = {}
    for splitter in splitters:
        at = 0
        for k in range(0, len(splitter) - TOKEN, TOKEN):
            at = numbers.setdefault((at, splitter[k : k + TOKEN]), len(numbers) + 1)
    return numbers


class _Shard:
    """Nodes of a shard in the order in which its sorted paths meet them, so parents come before children."""

    def __init__(self, skeleton: dict[tuple[int, bytes], int]) -> None:
        self.skeleton = skeleton
        self.parent, self.depth, self.number, self.chars = (array("q") for _ in range(4))
        self.members, self.first = array("q"), array("q")
        self.ends: list[bytes | None] = []
        self.path, self.stack = b"", []

    def _node(self, parent: int, depth: int, number: int, chars: int) -> int:
        for column, value in (
            (self.parent, parent), (self.depth, depth), (self.number, number),
            (self.chars, chars), (self.members, 0), (self.first, 1 << 62),
        ):
            column.append(value)
        self.ends.append(None)
        return len(self.ends) - 1

    def add(self, path: bytes, chars: list[int], end: bytes, members: int, first: int) -> None:
        if not self.stack:
            self.stack.append(self._node(-1, 0, 0, 0))
        stack = self.stack
        del stack[_common(self.path, path) + 1 :]
        for depth in range(len(stack), len(path) // TOKEN + 1):
            number = self.number[stack[-1]]
            if number >= 0:
                number = self.skeleton.get((number, path[(depth - 1) * TOKEN : depth * TOKEN]), -1)
            stack.append(self._node(stack[-1], depth, number, chars[depth - 1]))
        last = stack[-1]
        self.members[last], self.first[last], self.ends[last] = members, first, end
        self.path = path

    def finished(self) -> pa.RecordBatch | None:
        """All nodes: whole ones, and the shard's part of skeleton nodes (``number`` set)."""
        n = len(self.ends)
        if not n:
            return None
        parent, number, chars, members, first = self.parent, self.number, self.chars, self.members, self.first
        children, leaves, saved = (array("q", bytes(8 * n)) for _ in range(3))
        for i in range(n - 1, 0, -1):
            p = parent[i]
            members[p] += members[i]
            first[p] = min(first[p], first[i])
            if number[i] < 0:
                children[p] += 1
                leaves[p] += leaves[i] or 1
                saved[i] += (members[i] - 1) * chars[i]
                saved[p] += saved[i]
        up = np.frombuffer(parent, np.int64)
        whole = np.frombuffer(number, np.int64) < 0
        below = up.clip(0)
        of_skeleton = np.frombuffer(number, np.int64)[below]
        columns = [
            pa.array(np.frombuffer(number, np.int64), mask=whole),
            pa.array(of_skeleton, mask=~(whole & (of_skeleton >= 0))),
            pa.array(np.frombuffer(first, np.int64)),
            pa.array(np.frombuffer(self.depth, np.int64)),
            pa.array(np.frombuffer(first, np.int64)[below], mask=(up < 0) | (of_skeleton >= 0)),
            *[pa.array(np.frombuffer(c, np.int64)) for c in (members, children)],
            pa.array(np.where(whole, np.maximum(np.frombuffer(leaves, np.int64), 1), np.frombuffer(leaves, np.int64))),
            pa.array(np.frombuffer(saved, np.int64)),
            pa.array(self.ends, pa.binary()),
            pa.array(np.frombuffer(chars, np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_PART_NAMES)


_PART_NAMES = [
    "number", "under", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "end", "chars",
]
_PART = f"number bigint, under bigint, {NODE}, chars bigint"


def prefix_trie(paths: DataFrame) -> DataFrame:
    """The trie's nodes, from the rows of ``with_paths``.

    A node has conv_id, its smallest member; depth; parent_conv_id, its parent's smallest member (null at
    the root); n_convs, members; n_children; n_leaves, childless nodes in its subtree; saved, the sum
    over its subtree of (members - 1) * code points of a node's last text; and end, the digest of its path
    where conversations end there, else null. The root, without text, is a node like any other.
    """
    spark = paths.sparkSession
    grouped = paths.groupBy("path").agg(
        F.first("end").alias("end"),
        F.first("chars").alias("chars"),
        F.count("*").alias("members"),
        F.min("conv_id").alias("first"),
    )
    distinct = written_out(grouped, "distinct-paths")
    sizes = distinct.agg(F.count("*"), F.sum(F.octet_length("path") + TOKEN)).first()
    if not sizes[0]:
        return spark.createDataFrame([], NODE)
    shards = max(spark.sparkContext.defaultParallelism, -(-sizes[1] // SHARD_BYTES))
    shards = min(shards, sizes[0], MOST_SHARDS)
    share = min(1.0, SAMPLE_PER_SHARD * shards / sizes[0], SAMPLE_BYTES / sizes[1])
    chosen = F.pmod(F.xxhash64("path"), F.lit(1 << 20)) < int(share * (1 << 20))
    sample = distinct.where(chosen).select(F.substring("path", 1, LONGEST * TOKEN).alias("p")).collect()
    splitters = splitters_of((bytes(r["p"]) for r in sample), shards)
    sent = spark.sparkContext.broadcast(splitters)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = [bisect_right(sent.value, p.as_py()) for p in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *batch.columns], names=["shard", *batch.schema.names])

    def finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, skeleton = None, None
        for batch in batches:
            if shard is None:
                skeleton = skeleton_of(sent.value)
                shard = _Shard(skeleton)
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                shard.add(*row)
        made = shard.finished() if shard else None
        if made is not None:
            yield made

    kinds = "shard int, path binary, chars array<bigint>, `end` binary, members bigint, first bigint"
    rows = distinct.select("path", "chars", "end", "members", "first").mapInArrow(dealt, kinds)
    local = rows.repartitionById(len(splitters) + 1, F.col("shard")).sortWithinPartitions("path").drop("shard")
    parts = written_out(local.mapInArrow(finished, _PART), "shards")

    added = parts.where(F.col("number").isNotNull()).groupBy("number").agg(
        *[F.min(c).alias(c) for c in ("conv_id", "depth")],
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        *[F.max(c).alias(c) for c in ("end", "chars")],
    )
    known = spark.createDataFrame(_reduced(added.collect(), skeleton_of(splitters)), f"number bigint, {NODE}")
    named = F.broadcast(known.select(F.col("number").alias("under"), F.col("conv_id").alias("above")))
    whole = parts.where(F.col("number").isNull()).join(named, "under", "left")
    whole = whole.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return whole.select(*known.columns[1:]).unionByName(known.drop("number"))


def _reduced(added: list, skeleton: dict[tuple[int, bytes], int]) -> list[tuple]:
    """Whole skeleton nodes from the sums of the shards' parts, from the bottom up.

    As many rows as the skeleton has nodes, at most SKELETON_BYTES / TOKEN and the root.
    """
    up = {number: parent for (parent, _), number in skeleton.items()}
    sums = {r["number"]: r.asDict() for r in added}
    for number in sorted(sums, reverse=True):
        r = sums[number]
        r["n_leaves"] = r["n_leaves"] or 1
        if number:
            r["saved"] += (r["n_convs"] - 1) * r["chars"]
            above = sums[up[number]]
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved"] += r["saved"]
    return [
        (
            number, r["conv_id"], r["depth"], sums[up[number]]["conv_id"] if number else None,
            r["n_convs"], r["n_children"], r["n_leaves"], r["saved"], r["end"],
        )
        for number, r in sums.items()
    ]


def digests_of_ids(df: DataFrame, key: str, number: str) -> DataFrame:
    """(key, sha256): per key the SHA-256 of its numbers in decimal, ascending and joined by commas.

    Numbers are joined in pieces of a bounded range before the shuffle by key; a task then reads the
    pieces of a key in order and holds one at a time.
    """
    piece = F.floor(F.col(number) / IDS_PER_PIECE).alias("piece")
    joined = F.array_join(F.sort_array(F.collect_list(number)).cast("array<string>"), ",")
    pieces = df.groupBy(key, piece).agg(joined.alias("listed"))

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, now, digest = [key, "sha256"], None, None
        for batch in batches:
            keys, made = [], []
            for k, listed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if digest is not None and k == now:
                    digest.update(b",")
                else:
                    if digest is not None:
                        keys.append(now)
                        made.append(digest.hexdigest())
                    now, digest = k, hashlib.sha256()
                digest.update(listed.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.schema.field(0).type), pa.array(made, pa.string())], names=names)
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], batch.schema.field(0).type), pa.array([digest.hexdigest()])], names=names)

    kind = dict(df.dtypes)[key]
    ordered = pieces.repartition(F.col(key)).sortWithinPartitions(key, "piece").select(key, "listed")
    return ordered.mapInArrow(digested, f"`{key}` {kind}, sha256 string")
