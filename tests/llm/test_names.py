"""Columns of the given table that are named like an operator's own helpers."""

import pytest
from pyspark.sql import functions as F

from roadpulse.llm import bpe, decontaminate, quality, queries, repeats, simhash, tokens

NAMES = [
    "k", "h", "n", "all", "a", "z", "t", "d", "c0", "bucket", "kind", "blob", "target", "hashes", "own", "fp", "path", "row",
    "row_", "source", "Source_", "both", "in_0", "hits_0", "hits", "__doc", "__source__", "__text__", "__k", "__row", "__both", "b",
]


@pytest.fixture(scope="module")
def rows(spark, prose):
    texts = [t[:3_000] for t in prose]
    given = [(i, t) for i, t in enumerate(texts)] + [(3, texts[20]), (3, texts[21]), (None, None), (5, ""), (6, texts[20])]
    frame = spark.createDataFrame(given, "doc_id long, text string")
    return frame.select("*", *[F.concat(F.lit(c), "doc_id").alias(c) for c in NAMES if c not in ("hits",)])


def kept(made, rows, count=None):
    """Every given column but the text is as it was."""
    found = made.collect()
    assert len(found) == (rows.count() if count is None else count)
    for r in found:
        for c in rows.columns[2:]:
            assert r[c] == (None if r["doc_id"] is None else f"{c}{r['doc_id']}")
    return found


def test_cut_repeats(rows):
    found = kept(repeats.cut_repeats(rows), rows)
    plain = repeats.cut_repeats(rows.select("doc_id", "text")).collect()
    assert sorted((str(r["doc_id"]), r["kept"]) for r in found) == sorted((str(r["doc_id"]), r["kept"]) for r in plain)


def test_too_large_ids_that_repeat(spark, rows):
    large = rows.select((F.col("doc_id") + F.lit(1 << 61)).alias("doc_id"), "text")
    with pytest.raises(ValueError, match="too large"):
        repeats.cut_repeats(large)


def test_scores_tokens_and_hits(spark, rows):
    benchmark = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    trees = quality.train(rows, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    kept(quality.score(rows, trees), rows)
    kept(bpe.encode_and_decode(rows, queries.WORD_BPE), rows)
    kept(decontaminate.benchmark_hits(rows, benchmark, out="found"), rows)
    kept(decontaminate.benchmark_hits(rows, benchmark.unionByName(benchmark.selectExpr("2L AS item_id", "'re st' AS text")), out="found", block_items=1), rows)
    kept(tokens.with_tree(rows, queries.BYTE_RANKS, queries.public_tokenizers.PATTERN), rows)


def test_one_per_group(rows):
    found = simhash.one_per_group(rows, 3, 2)
    assert found.columns == rows.columns
    kept(found, rows, found.count())
