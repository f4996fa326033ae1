"""Suffix-array dedup against a dictionary of all windows."""

import random

import numpy as np
import pytest

from roadpulse.llm import repeats as R
from roadpulse.llm.suffixes import suffix_array


def by_hand(rows, length):
    """(key, kept bytes, spans) of every row."""
    owner = {}
    for key, text in rows:
        data = (text or "").encode()
        if key is not None:
            for i in range(len(data) - length + 1):
                w = data[i : i + length]
                owner[w] = min(owner.get(w, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - length + 1 if key is not None else 0):
            if owner[data[i : i + length]] < key:
                gone[i : i + length] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
        out.append((str(key), bytes(np.frombuffer(data, np.uint8)[~gone]), edge.reshape(-1, 2).tolist()))
    return sorted(out)


def cut(spark, rows, length=50, gram=24):
    df = spark.createDataFrame([(*r, "c", 5, "b") for r in rows], "doc_id long, text string, kept string, d int, blob string")
    got = R.cut_repeats(df, length=length, gram=gram).collect()
    assert all(r["d"] == 5 and r["blob"] == "b" for r in got)
    return sorted((str(r["doc_id"]), bytes(r["kept"]), [[s["start"], s["stop"]] for s in r["spans"]]) for r in got)


def test_equals_all_windows(spark, prose):
    rows = [(i * 3, t) for i, t in enumerate(prose)] + [(None, prose[20]), (1, None), (2, "")]
    assert cut(spark, rows) == by_hand(rows, 50)


@pytest.mark.parametrize("crowd", [1, 2, 5])
def test_crowded_anchors(spark, prose, crowd, monkeypatch):
    monkeypatch.setattr(R, "CROWD", crowd)
    monkeypatch.setattr(R, "FLUSH", 3_000)
    rng = random.Random(crowd)
    passage = prose[40][:90] * 2
    around = ["".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(40)]
    rows = [(i % 33, a + passage + b) for i, (a, b) in enumerate(zip(around, around[3:] + around[:3]))]
    rows += [(50 + i, t) for i, t in enumerate(prose)]
    assert cut(spark, rows) == by_hand(rows, 50)


def test_characters_that_share_bytes(spark):
    common = "ü" * 3 + "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJK"
    rows = [(1, common + "é" + "x" * 60), (2, "q" + common + "è" + "x" * 55)]
    want = by_hand(rows, 50)
    assert cut(spark, rows) == want
    df = spark.createDataFrame([(k, b) for k, b, _ in want], "doc_id string, kept binary")
    assert [r["text"] for r in R.whole_characters(df).orderBy("doc_id").collect()][0] == rows[0][1]


@pytest.mark.parametrize("seed", range(3))
def test_short_windows_over_few_letters(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(12), "".join(rng.choice("ab") for _ in range(rng.randrange(60)))) for _ in range(30)]
    assert cut(spark, rows, length=12, gram=4) == by_hand(rows, 12)


def test_one_letter_chunk_borders_and_order(spark, monkeypatch):
    monkeypatch.setattr(R, "CHUNK", 64)
    monkeypatch.setattr(R, "FLUSH", 500)
    text = "".join(chr(97 + i * i % 23) for i in range(700))
    rows = [(9, "a" * 300), (8, "a" * 200), (7, text[100:400]), (6, text), (5, text[350:]), (4, text[:160]), (6, text)]
    assert cut(spark, rows) == by_hand(rows, 50)


def test_no_rows(spark):
    assert cut(spark, []) == []
    assert cut(spark, [(1, "short")]) == [("1", b"short", [])]


def test_suffix_order():
    rng = np.random.default_rng(5)
    for n in [*range(30), 200]:
        for letters in (1, 2, 200):
            row = rng.integers(1, letters + 1, n)
            listed = row.tolist()
            assert suffix_array(row).tolist() == sorted(range(n), key=lambda i: listed[i:])
