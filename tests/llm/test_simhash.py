"""SimHash near-dedup against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roadpulse.llm import components, simhash as S


def by_hand(text, shingle=3):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(rows, distance):
    """Smallest id reachable, by all pairs."""
    parent = {i: i for i, _ in rows}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in rows:
        for j, b in rows:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i, _ in rows}


def test_fingerprints_and_groups(spark, prose):
    rows = list(enumerate([*prose, None, "\x1cA B\x85c"]))
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, k int")
    hashed = S.with_simhash(docs, 3)
    want = [(i, by_hand(t)) for i, t in rows]
    assert {r[0]: r[1] for r in hashed.select("doc_id", S.hex_digits(F.col("fingerprint"))).collect()} == {
        i: f"{h:016x}" for i, h in want
    }
    got = {r["doc_id"]: r["component"] for r in S.near_groups(hashed, 2).collect()}
    assert got == groups_by_hand(want, 2)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_masks_cover_every_pair(distance):
    rng = random.Random(distance)
    for level in range(3):
        masks = S.masks(distance, level)
        assert len(masks) == 2 ** (distance + 1) - 1
        for _ in range(3000):
            gap = sum(1 << b for b in rng.sample(range(64), distance))
            assert any(not (gap & m & (1 << 64) - 1) for m in masks)


def test_levels_keep_every_bit():
    kept = 0
    for level in range(S.LEVELS):
        for m in S.masks(2, level)[:1]:
            kept |= m & (1 << 64) - 1
    assert kept == (1 << 64) - 1


def test_full_buckets_are_split_without_loss(spark):
    rng = random.Random(3)
    base = rng.getrandbits(64)
    values = {base}
    while len(values) < 300:
        values.add(rng.choice(sorted(values)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = [(int(np.uint64(v).astype(np.int64)),) for v in values]
    links = S.near_links(spark.createDataFrame(signed, "fp long"), 2, most=4)
    rows = [(v, v) for v in (int(np.int64(x).astype(np.uint64)) for (x,) in signed)]
    want = groups_by_hand(rows, 2)
    found = components.connected_components(links)
    tops = {}
    for r in found.collect():
        tops.setdefault(r["component"], set()).add(int(np.int64(r["node"]).astype(np.uint64)))
    expected = {}
    for v, t in want.items():
        expected.setdefault(t, set()).add(v)
    assert sorted(map(sorted, tops.values())) == sorted(sorted(g) for g in expected.values() if len(g) > 1)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *star, (5, 5), (2000, 1999)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {1999: 1999, 2000: 1999}
    assert components.connected_components(links.limit(0)).collect() == []


def test_null_and_repeated_keys(spark):
    rows = [(None, 7), (1, 7), (2, 7 << 40), (2, 7), (3, 7 << 40), (3, 7 << 40), (4, -1)]
    df = spark.createDataFrame(rows, "doc_id long, fingerprint long")
    got = sorted((str(r["doc_id"]), r["fingerprint"], r["component"]) for r in S.near_groups(df, 2).collect())
    want = [("1", 7, 1), ("2", 7, 1), ("2", 7 << 40, 1), ("3", 7 << 40, 1), ("3", 7 << 40, 1), ("4", -1, 4), ("None", 7, None)]
    assert got == want
    assert S.near_groups(df.limit(0), 2).collect() == []


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text), (3, text), (3, text), (None, text), (9, "other words here"), (8, None), (7, "")]
    kept = S.one_per_group(spark.createDataFrame(rows, "doc_id long, text string"), 3, 2).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == ["3", "7", "9", "None"]
