"""BPE encoding and decoding against the tokenizer file's own library."""

import random
import unicodedata

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roadpulse.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " \n\t", "a\x1cb \x1f c", "İIΣΑΣ ΑΣ", "<|endoftext|> Hi<|startoftext|>x <|ENDOFTEXT|>", "e\u0301 \u0301a",
    "don't I'LL we're 123 ½ ² ..!!\u200b x\u0085y\u00a0z\u3000", "日本語テキスト 🙂🙂🏽", "ǅ ŉ ß ẞ K Å", "\x00a\x7f", "x" * 3000, "<|", "'s's 'S",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_rows_equal_the_library(spark, prose, library):
    texts = [*ODD, *prose, None]
    df = spark.createDataFrame([(i, t, "ids", 3) for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded int")
    ids = bpe.encode(df, PATH)
    back = bpe.decode(ids, PATH, out="back")
    assert sorted(back.collect()) == sorted(bpe.encode_and_decode(df, PATH, out="back").select(*back.columns).collect())
    rows = {r["doc_id"]: r for r in back.collect()}
    for i, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert list(rows[i]["ids"]) == want
        assert rows[i]["back"] == library.decode(want, skip_special_tokens=False)
        assert rows[i]["decoded"] == 3 and rows[i]["text"] == text


def test_random_characters(library):
    chunks, rng = bpe._Chunks(bpe.Vocabulary(open(PATH, encoding="utf-8").read())), random.Random(9)
    # Without characters that are younger than one of the two sides' Unicode tables.
    young = {*range(0x0890, 0x08A0), *range(0x1ABF, 0x1ACF), 0x0C3C, 0x0898, *range(0x08C8, 0x08D4), *range(0x1DFA, 0x1DFB)}
    pool = [c for c in map(chr, range(0x2FFF)) if unicodedata.category(c) not in ("Cn", "Cs") and ord(c) not in young]
    for _ in range(500):
        text = "".join(rng.choice(pool) if rng.random() < 0.5 else rng.choice(" aen'sT1.") for _ in range(30))
        ids = memoryview(chunks.encode(text)).cast("i").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_table_and_null_ids(spark):
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()] == ["", ""]


def test_memory_starts_anew(monkeypatch, library, prose):
    monkeypatch.setattr(bpe, "MOST_WORDS", 10)
    chunks = bpe._Chunks(bpe.Vocabulary(open(PATH, encoding="utf-8").read()))
    for text in prose[:20]:
        ids = memoryview(chunks.encode(text)).cast("i").tolist()
        chunks.forget()
        assert ids == library.encode(text, add_special_tokens=False).ids
