"""Benchmark decontamination against a search word by word."""

import random
import re

import pytest

from roadpulse.llm import decontaminate as D


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def by_hand(docs, items, window):
    out = []
    for key, text in docs:
        own, hit, found = words(text), set(), set()
        for item, body in items:
            asked = words(body)
            for i in range(max(len(asked) - window, 0) + 1 if asked and item is not None else 0):
                run = asked[i : i + window]
                for at in range(len(own) - len(run) + 1):
                    if own[at : at + len(run)] == run:
                        hit |= set(range(at, at + len(run)))
                        found.add(item)
        out.append((str(key), len(own), len(hit), sorted(found)))
    return sorted(out)


def spans_cover(rows):
    return all(sum(s["stop"] - s["start"] for s in r["hits"]["spans"]) == r["hits"]["n_hit"] for r in rows)


@pytest.mark.parametrize("blocks", [20_000, 3])
def test_equals_a_search_by_hand(spark, prose, blocks):
    rng = random.Random(2)
    items = [(i, " ".join(words(rng.choice(prose))[: rng.choice([1, 3, 15, 40])])) for i in range(12)]
    items += [(3, "other windows of item three that stand in the document below once"), (None, prose[20]), (50, None), (51, "?!")]
    docs = [(i, t) for i, t in enumerate(prose)] + [(None, items[-4][1].upper()), (1, None), (900, "x " + " ".join(w for _, t in items[:4] for w in [t]))]
    frame = spark.createDataFrame([(*d, 1, "h") for d in docs], "doc_id long, text string, hits int, i string")
    asked = spark.createDataFrame([(*i, "w") for i in items], "item_id long, text string, w string")
    rows = D.benchmark_hits(frame, asked, block_items=blocks).collect()
    assert all(r["i"] == "h" for r in rows) and spans_cover(rows)
    got = sorted((str(r["doc_id"]), r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"]) for r in rows)
    assert got == by_hand(docs, items, 10)


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "red green blue"), (2, "blue x x red x green"), (3, "red x x x x x x green blue"), (4, "red green")],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(7, "red green blue")], "item_id long, text string")
    got = {r["doc_id"]: r["hits"] for r in D.benchmark_hits(docs, items, within=5).collect()}
    assert {k for k, h in got.items() if h["near_items"] == [7]} == {1, 2}
    assert {k for k, h in got.items() if h["items"] == [7]} == {1}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.benchmark_hits(docs.limit(0), items).collect() == []
    hits = D.benchmark_hits(docs, items.limit(0)).first()["hits"]
    assert (hits["n_words"], hits["n_hit"], hits["items"], hits["spans"]) == (3, 0, [], [])


def test_blocks_are_bounded_by_bytes_too(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"{'pad ' * i}alpha beta gamma{i} delta") for i in range(12)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"beta gamma{i}") for i in range(0, 24, 2)], "item_id long, text string")
    want = sorted(map(str, D.benchmark_hits(docs, items).collect()))
    sent = []
    plain = D.written_out
    monkeypatch.setattr(D, "written_out", lambda df, label: sent.append(label) or plain(df, label))
    monkeypatch.setattr(D, "BLOCK_BYTES", 40)
    assert sorted(map(str, D.benchmark_hits(docs, items).collect())) == want and len(sent) > 2
