"""SimHash near-dedup with covering locality-sensitive hashing.

For a radius r every bit position has a non-zero vector of r + 1 bits, and table v keeps the bits whose
vector has an odd product with v. The vectors of r differing bits leave some v orthogonal to all of them,
so two fingerprints within the radius are equal in that table: 2**(r+1) - 1 tables miss nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, with_computed
from roadpulse.llm.components import connected_components
from roadpulse.session import written_out

BITS = 64
MOST = 1024  # fingerprints that are compared with each other; a fuller bucket is split by a new level
LEVELS = 12  # a level keeps about 4/7 of the bits, so these leave no bit out


def text_simhash(text: str, shingle: int) -> int:
    """The fingerprint of a whole text as a signed 64-bit number; 0 without words."""
    found = text.encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    runs = zip(*(found[i:] for i in range(shingle))) if len(found) >= shingle else [found]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, 42) for x in map(b" ".join, runs)], dtype="<u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def with_simhash(df: DataFrame, shingle: int, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """The rows with ``out``, the fingerprint of every whole text (bigint).

    Words are runs without ASCII white space after lower-casing A-Z; a text shorter than a shingle is
    one shingle. A null text, and one without words, has fingerprint 0. Other columns pass through.
    """

    def start() -> Callable:
        def compute(texts: pa.Array) -> pa.Array:
            return pa.array([text_simhash(x.as_py() or "", shingle) for x in texts], pa.int64())

        return compute

    return with_computed(df, text, out, "bigint", start)


def masks(distance: int, level: int = 0) -> list[int]:
    """The bit masks of the covering tables as signed 64-bit numbers."""
    most = 2 ** (distance + 1) - 1
    vectors = np.random.default_rng(level).permutation(np.arange(BITS) % most + 1)
    found = []
    for v in range(1, most + 1):
        odd = np.array([int(x & v).bit_count() & 1 for x in vectors], dtype=np.uint8)
        found.append(int(np.packbits(odd, bitorder="little").view("<i8")[0]))
    return found


def linked(fingerprints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is within the distance: one per fingerprint beyond the first of a group."""
    found, left = [], np.ones(len(fingerprints), dtype=bool)
    for i in range(len(fingerprints)):
        if not left[i]:
            continue
        left[i] = False
        frontier = [i]
        while frontier:
            j = frontier.pop()
            near = np.flatnonzero(left & (np.bitwise_count(fingerprints ^ fingerprints[j]) <= distance))
            left[near] = False
            frontier += near.tolist()
            found += [(int(fingerprints[k]), int(fingerprints[j])) for k in near]
    return found


def _links_of_buckets(buckets: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) within each list of fingerprints."""

    def run(batches):
        for batch in batches:
            found = []
            for listed in batch.column(0):
                own = np.unique(listed.values.to_numpy())
                found += linked(own.view(np.uint64), distance)
            signed = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], names=["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def near_links(fingerprints: DataFrame, distance: int, most: int = MOST) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``distance`` bits, directly or by others.

    ``fingerprints`` has one column of distinct values. A bucket of over ``most`` fingerprints is dealt
    again by the masks of a new level, which keep other bits; a pair within the distance still meets in
    one of the new tables. Nothing is dropped: after some levels every bit is kept and a bucket is one value.
    """
    fp = fingerprints.columns[0]
    rest = fingerprints.select(F.col(fp).alias("fp"), F.lit(0).cast("bigint").alias("path"))
    links = None
    for level in range(LEVELS):
        tables = [
            F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
            for t, mask in enumerate(masks(distance, level))
        ]
        keyed = rest.select("fp", "path", F.explode(F.array(*tables)).alias("x")).select(
            "fp", F.xxhash64("path", "x.t", "x.key").alias("path")
        )
        sizes = keyed.groupBy(F.col("path").alias("p")).agg(F.count("*").alias("n")).where("n > 1")
        shared = written_out(keyed.join(sizes, F.col("path") == F.col("p")).select("fp", "path", "n"), f"buckets-{level}")
        small = shared.where(F.col("n") <= most).groupBy("path").agg(F.collect_list("fp").alias("own"))
        found = _links_of_buckets(small.select("own"), distance)
        links = found if links is None else links.unionByName(found)
        rest = shared.where(F.col("n") > most).select("fp", "path")
        if rest.isEmpty():
            return links.distinct()
    raise AssertionError("every bit is kept after the last level")


def near_groups(df: DataFrame, distance: int, key: str = "doc_id", fingerprint: str = "fingerprint") -> DataFrame:
    """(key, fingerprint, ``component``): the smallest key that a row reaches by links within ``distance``.

    Equal fingerprints are one node, so copies are never paired. Rows that repeat a key share its
    component. A row with a null key links nothing and has a null component. No rows give no rows.
    """
    rows = written_out(df.select(F.col(key).alias("k"), F.col(fingerprint).alias("fp")), "fingerprints")
    known = rows.where(F.col("k").isNotNull())
    nodes = written_out(known.groupBy("fp").agg(F.min("k").alias("first"), F.max("k").alias("last")), "nodes")
    links = near_links(nodes.select("fp"), distance)
    first, second = nodes.select(F.col("fp").alias("fa"), F.col("first").alias("ka")), nodes.select(
        F.col("fp").alias("fb"), F.col("first").alias("kb")
    )
    between = links.join(first, F.col("a") == F.col("fa")).join(second, F.col("b") == F.col("fb")).select("ka", "kb")
    # A key that stands in rows of several fingerprints links them too.
    repeated = known.groupBy("k").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low != high").select("k")
    several = known.join(repeated, "k", "left_semi").join(nodes, "fp").select(F.col("k").alias("ka"), F.col("first").alias("kb"))
    groups = connected_components(between.unionByName(several))
    places = nodes.join(groups, F.col("first") == F.col("node"), "left").select(
        F.col("fp").alias("f"), F.coalesce("component", "first").alias("component")
    )
    return rows.join(places, F.col("fp") == F.col("f"), "left").select(
        F.col("k").alias(key),
        F.col("fp").alias(fingerprint),
        F.when(F.col("k").isNotNull(), F.col("component")).alias("component"),
    )


def one_per_group(
    docs: DataFrame, shingle: int, distance: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of the smallest key of each group of near-duplicates; of rows that repeat a key, one.

    Rows with a null key belong to no group and stay. All columns pass through.
    """
    own = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    groups = near_groups(with_simhash(own, shingle, "t", "fp").drop("t"), distance, "k", "fp")
    name, row = free_name(docs, "k"), free_name(docs, "row")
    beaten = groups.where(F.col("component") != F.col("k")).select(F.col("k").alias(name)).distinct()
    left = docs.join(beaten, F.col(f"`{key}`") == F.col(name), "left_anti")
    repeats = own.where(F.col("k").isNotNull()).groupBy("k").count().where("count > 1")
    if repeats.isEmpty():
        return left
    first = Window.partitionBy(F.col(f"`{key}`")).orderBy(F.xxhash64(F.col(f"`{text}`")))
    numbered = left.withColumn(row, F.row_number().over(first))
    return numbered.where(F.col(f"`{key}`").isNull() | (F.col(row) == 1)).drop(row)


def hex_digits(fingerprint: Column) -> Column:
    """The 16 lowercase hex digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
