import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import queries, trie

TURNS = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    """The nodes as the contract defines them, from (conv_id, turn, role, text) without ties."""
    own = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        if conv is not None:
            own.setdefault(conv, []).append((role or "", text or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
            if d:
                children.setdefault(turns[: d - 1], set()).add(turns[:d])
    out = []

    def walk(node):
        below = [walk(x) for x in children.get(node, ())]
        found = members[node]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(found) - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(map(str, sorted(c for c in found if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(node), parent, len(found), len(children.get(node, ())), leaves, saved, sha))
        return leaves, saved

    if built:
        walk(())
    return sorted(out, key=str)


def found(spark, folder, rows, schema=TURNS):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/conversations.parquet")
    made = queries.op12_conversation_prefix_trie(spark, str(folder)).collect()
    return sorted([tuple(r[:8]) for r in made], key=str)


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, shards):
    monkeypatch.setattr(trie, "SHARD_BYTES", 1 if shards == 40 else 1 << 20)
    monkeypatch.setattr(trie, "MOST_SHARDS", shards)
    rng = random.Random(shards)
    texts = ["", "a", "ß💡", "a b", "same"]
    rows = []
    for c in range(0, 640, 2):
        for t in range(rng.choice([1, 2, 3, 7, 9])):
            rows.append((c, t if t else None, rng.choice([None, "user", "system"]), rng.choice([None, *texts])))
    rows += [(c, t, "user", "copy") for c in range(701, 760) for t in range(6)]
    rows += [(None, 0, "user", "no conversation")]
    rng.shuffle(rows)
    assert found(spark, tmp_path, rows) == by_hand(rows)


def test_turnless_and_long_conversations(spark, tmp_path):
    alone = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(alone, 0, "user", "x"), (300, 0, "user", "y" * 100_000)]
    rows += [(200, t, "user", f"turn {t}") for t in range(700)]
    nodes = found(spark, tmp_path, rows)
    assert nodes == by_hand(rows)
    root = next(n for n in nodes if n[1] == 0)
    assert root[7] == hashlib.sha256(str(alone).encode()).hexdigest() and root[3] == 3


def test_empty_table(spark, tmp_path):
    assert found(spark, tmp_path, []) == []


def test_ties_and_other_columns(spark, tmp_path):
    rows = [(1, 0, r, x, 9, "p") for r, x in (("user", "b"), ("user", "a"), ("assistant", "c"), ("user", "a"))]
    schema = f"{TURNS}, path long, `end` string"
    nodes = found(spark, tmp_path, rows * 2, schema)
    (tmp_path / "again").mkdir()
    assert nodes == found(spark, tmp_path / "again", rows[::-1] * 2, schema)
    assert len(nodes) == 9 - zlib.crc32(b"1") % 6


def test_splitters_and_skeleton(monkeypatch):
    rng = random.Random(2)
    turn = [bytes([i]) * trie.TOKEN for i in range(4)]
    paths = [b"".join(rng.choice(turn) for _ in range(rng.randint(0, 6))) for _ in range(300)]
    splitters = trie.splitters_of(paths, 20)
    assert splitters == sorted(set(splitters)) and 10 < len(splitters) < 20
    skeleton = trie.skeleton_of(splitters)
    assert all(parent < number for (parent, _), number in skeleton.items())
    assert sorted(skeleton.values()) == list(range(1, len(skeleton) + 1))
    assert len(skeleton) == len({s[:k] for s in splitters for k in range(trie.TOKEN, len(s), trie.TOKEN)})
    monkeypatch.setattr(trie, "SKELETON_BYTES", 300)
    assert sum(map(len, trie.splitters_of(paths, 20))) <= 300
    assert trie.splitters_of([], 5) == [] and trie.splitters_of([b""], 5) == []


def test_digests_of_ids(spark, monkeypatch):
    monkeypatch.setattr(trie, "IDS_PER_PIECE", 10)
    groups = {"a": list(range(-25, 60, 3)), "b": [7], "c": [2**40, 5, 11]}
    rows = spark.createDataFrame([(k, i) for k, ids in groups.items() for i in ids], "k string, i long").repartition(3)
    made = {r["k"]: r["sha256"] for r in trie.digests_of_ids(rows, "k", "i").collect()}
    assert made == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in groups.items()}
    assert trie.digests_of_ids(rows.where(F.lit(False)), "k", "i").collect() == []
