"""Edit-aware counts equal counting the edited text from the start."""

import base64
import random

import public_tokenizers
import pytest

from roadpulse.llm import tokens as T

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def counter():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return T.Counter(ranks, PATTERN)


def test_random_edits(counter, monkeypatch):
    monkeypatch.setattr(T, "LEAF", 3)
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice("ab 'rels  \n\n1é.,!") for _ in range(rng.randint(0, 150)))
        tree = T.build(text, counter)
        for _ in range(6):
            added = "".join(rng.choice("a 's\n1") for _ in range(rng.choice([0, 1, 30])))
            text, _ = T.edit(text, tree, rng.randint(-2, len(text) + 2), rng.choice([0, 1, 9, 99]), added, counter)
            assert (tree.chars, tree.tokens) == (len(text), len(counter.encoding.encode_ordinary(text)))


def test_only_the_touched_region_is_encoded(counter):
    text = "some words of text, " * 5000
    tree = T.build(text, counter)
    new, work = T.edit(text, tree, 50_000, 3, "xyz", counter)
    assert work < 1_500 and tree.tokens == len(counter.encoding.encode_ordinary(new))


def test_rows(spark, counter):
    edits = "array<struct<start:int,removed:int,inserted:string>>"
    rows = [
        (1, "hello there world", [(5, 1, ", "), (0, 0, "Oh ")], 9),
        (2, None, [(0, 5, "new")], 9),
        (None, "", None, 9),
        (3, "abc" * 30_000, [(100, 100, None), (None, None, "x")], 9),
        (3, "abc", [], 9),
    ]
    df = spark.createDataFrame(rows, f"doc_id long, text string, edits {edits}, reencoded_chars int")
    got = T.with_edits(T.with_tree(df, PATH, PATTERN), PATH, PATTERN).collect()
    want = ["Oh hello, there world", "new", "", "x" + "abc" * 30_000, "abc"]
    want[3] = "x" + ("abc" * 30_000)[:100] + ("abc" * 30_000)[200:]
    assert [r["text"] for r in got] == want
    assert [r["tree"]["n_tokens"] for r in got] == [len(counter.encoding.encode_ordinary(t)) for t in want]
    assert [sum(r["tree"]["leaf_chars"]) for r in got] == [len(t) for t in want]
    assert T.with_tree(df.limit(0), PATH, PATTERN).collect() == []
