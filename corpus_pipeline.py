"""A corpus pipeline: five stages over the documents, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import bpe, decontaminate, quality, repeats, simhash
from roadpulse.llm.common import free_name, table
from roadpulse.llm.queries import DISTANCE, KEEP_SCORE, SHINGLE, WORD_BPE
from roadpulse.session import written_out


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    trees = quality.train(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "score")
    scored = quality.score(docs, trees, out=score)
    return scored.where(F.col(score) >= KEEP_SCORE).select(*_columns(docs))


def keep_one_of_a_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near-duplicates by SimHash."""
    return simhash.one_per_group(docs, SHINGLE, DISTANCE)


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the 50-byte strings that a smaller document has too."""
    kept, spans = free_name(docs, "kept"), free_name(docs, "spans")
    cut = repeats.whole_characters(repeats.cut_repeats(docs, kept=kept, spans=spans), kept)
    return cut.withColumn("n_chars", F.length("text").cast("bigint")).select(*_columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands."""
    out = free_name(docs, "hits")
    hits = decontaminate.benchmark_hits(docs, table(spark, sf_dir, "benchmark"), out=out)
    return hits.where(F.col(f"{out}.n_hit") == 0).select(*_columns(docs))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text that they decode to."""
    return bpe.encode_and_decode(docs.select("doc_id", "lang", "source", "text"), WORD_BPE).select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_of_a_group),
    ("suffix-array dedup", cut_repeated_strings),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", to_tokens),
]

# Trees, hashes of 64 bits and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written_out(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
