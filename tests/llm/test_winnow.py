"""Winnowing against the definition, window by window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import winnow as W


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def made(spark, prose):
    rows = [(i, t, 1, 2) for i, t in enumerate([*prose, None])]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, __k int".replace("__k", "k"))
    got = W.with_fingerprint(df, "text", "fp").select(
        "doc_id", "fp", F.transform("fp", lambda v: F.shiftright(v, 31)).alias("h"), W.positions(F.col("fp")).alias("p")
    )
    return {r["doc_id"]: r for r in got.collect()}, [*prose, None]


def test_rightmost_minimum_of_each_window(spark, made):
    found, texts = made
    base = {w for t in texts for w in words(t)}
    code = {r[0]: r[1] for r in spark.createDataFrame([(w,) for w in base], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(W._PRIME))).collect()}
    for i, text in enumerate(texts):
        own = [code[w] for w in words(text)]
        grams = []
        for j in range(len(own) - W.GRAM + 1):
            h = 0
            for x in own[j : j + W.GRAM]:
                h = (h * W._BASE + x) % W._PRIME
            grams.append(h)
        if not grams:
            assert len(found[i]["p"]) == (1 if own else 0)
            continue
        keep = []
        for j in range(max(len(grams) - W.WINDOW, 0) + 1):
            window = grams[j : j + W.WINDOW]
            least = min(range(len(window)), key=lambda k: (window[k], -k)) + j
            if least not in keep:
                keep.append(least)
        assert list(found[i]["p"]) == keep
        assert list(found[i]["h"]) == [grams[k] for k in keep]


def test_shared_words_share_a_hash(spark):
    rng = random.Random(1)
    run = " ".join(f"r{i}" for i in range(W.GRAM + W.WINDOW - 1))
    rows = [(i, " ".join([*(f"a{rng.random()}" for _ in range(i)), run, "tail " * i])) for i in range(12)]
    df = W.with_fingerprint(spark.createDataFrame(rows, "doc_id long, text string"), "text", "fp")
    sets = [set(r[0]) for r in df.select(W.hashes(F.col("fp"))).collect()]
    assert all(a & b for a in sets for b in sets)


def test_edited_text_and_next(spark, prose):
    rows = [(i * 7 - 50, t) for i, t in enumerate(prose)]
    shuffled = rows[::2] + rows[1::2]
    got = {r["doc_id"]: r for r in W.edited_beside_next(spark.createDataFrame([(*r, "x") for r in shuffled], "doc_id long, text string, next string")).collect()}
    for (key, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        part = len(text) // 4
        assert got[key]["edited"] == text[: len(text) - part] + following[:part]
    fingerprints = {key: r["fingerprint"] for key, r in got.items()}
    for (key, _), (after, _) in zip(rows, rows[1:] + rows[:1]):
        assert got[key]["next_fingerprint"] == fingerprints[after]


def test_odd_rows(spark):
    schema = "doc_id long, text string"
    assert W.edited_beside_next(spark.createDataFrame([], schema)).collect() == []
    alone = W.edited_beside_next(spark.createDataFrame([(1, "abcdefgh")], schema)).first()
    assert alone["edited"] == "abcdefab"
    rows = [(None, None), (None, "a b c d e f g h"), (2, "x y"), (2, "x y"), (2, "z")]
    got = W.edited_beside_next(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 and sorted(r["text"] for r in got) == sorted((t or "") for _, t in rows)
    like = spark.createDataFrame([([1], [1]), ([], []), ([1, 2], [2, 3]), ([], [1])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in like.select(W.likeness(F.col("a"), F.col("b"))).collect()] == [1.0, 1.0, 1 / 3, 0.0]


def test_characters_by_the_definition(spark, prose):
    texts = [t for t in prose if len(t) < 3000] + ["𝔘𝔫𝔦 😀" * 9, "日本語の文章です。" * 3, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = W.with_fingerprint(df, "text", "fp", "characters").select("doc_id", W.positions(F.col("fp")).alias("p"), F.transform("fp", lambda v: F.shiftright(v, 31)).alias("h"))
    gram, window = W.SIZES["characters"]
    for r in made.collect():
        own = "".join(words(texts[r["doc_id"]]))
        hashes = []
        for j in range(len(own) - gram + 1):
            h = 0
            for c in own[j : j + gram]:
                h = (h * W._BASE + ord(c)) % W._PRIME
            hashes.append(h)
        keep = []
        for j in range(max(len(hashes) - window, 0) + 1 if hashes else 0):
            part = hashes[j : j + window]
            least = min(range(len(part)), key=lambda k: (part[k], -k)) + j
            if least not in keep:
                keep.append(least)
        if hashes:
            assert list(r["p"]) == keep and list(r["h"]) == [hashes[k] for k in keep]
        else:
            assert len(r["p"]) == (1 if own else 0)


def test_near_copies_without_spaces_or_with_few_words(spark):
    rng = random.Random(3)
    chinese = "".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(400))
    token = "".join(rng.choice("abcdefghij0123456789") for _ in range(400))
    few = "internationalisation misunderstandings counterrevolutionary"
    rows = [(1, chinese), (2, token), (3, few)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = W.edited_beside_next(docs)
    own, changed, following = (W.hashes(F.col(c)) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"))
    for r in made.select("doc_id", W.likeness(own, changed).alias("near"), W.likeness(own, following).alias("far")).collect():
        assert 0.3 < r["near"] < 1 and r["far"] < 0.1


def test_joined_fingerprint_is_that_of_the_edited_text(spark, prose):
    rng = random.Random(5)
    texts = [*prose, *("".join(rng.choice("ab é中.") for _ in range(n)) for n in [*range(20, 420, 9), 900, 30, 2000])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = W.edited_beside_next(docs).withColumnRenamed("edited_fingerprint", "joined")
    whole = W.with_fingerprint(made, "edited", "whole", "characters")
    assert [(r["joined"] == r["whole"]) for r in whole.select("joined", "whole").collect()] == [True] * len(texts)
