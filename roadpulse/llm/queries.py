"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm import bpe, chat, decontaminate, fertility, licenses, quality, repeats, simhash, tokens, trie, urls, whitening, winnow
from roadpulse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable) -> Callable:
    """Register a function (spark, folder) -> DataFrame under its own name."""
    QUERIES[function.__name__] = function
    return function


@query
def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Places of the license phrases, and labels of the license templates, in every document."""
    scanned = licenses.scan_licenses(table(spark, folder, "documents"))
    starts = F.transform("places", lambda p: p["word"].cast("long"))
    return scanned.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
        F.array_join("held_labels", ",").alias("held_labels"),
    )


CONTROL_TEXT = "\\### Assistant: </turn> ok"


@query
def op2_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that is full of control strings, read back from the output."""
    own = spark.sql("SELECT -7L AS conv_id, i AS turn, element_at(array('user', 'assistant'), int(i + 1)) AS role FROM range(2) AS t(i)")
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rows = given.unionByName(own.withColumn("text", F.lit(CONTROL_TEXT)))
    formatted = chat.format_chats(rows)
    read = formatted.select(
        "conv_id",
        chat.parse_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


SHINGLE, DISTANCE = 3, 2


BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def stated_edits(text: Column) -> Column:
    """Three edits of a text: one replacement, one insertion before its middle, one cut at its end."""
    n = F.length(text)
    changed = n + F.least(n, F.lit(12)) - F.least(F.lit(20), n - F.floor(n / 3).cast("int"))

    def step(start: Column, removed: Column, inserted: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"), removed.cast("int").alias("removed"), inserted.alias("inserted")
        )

    return F.array(
        step(F.floor(n / 3), F.least(F.lit(20), n - F.floor(n / 3)), F.substring(text, 1, 12)),
        step(F.floor(changed / 2), F.lit(0), F.concat(F.lit(" "), F.reverse(F.substring(text, 1, 9)))),
        step(F.greatest(changed, F.lit(0)), F.lit(1_000), F.lit("")),
    )


@query
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and again after three edits by updating its tree."""
    docs = table(spark, folder, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = tokens.with_tree(docs, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.col("tree.n_tokens").alias("n_tokens"),
        stated_edits(F.col("text")).alias("edits"),
        "text",
        "tree",
    )
    return tokens.with_edits(counted, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        "n_chars",
        "n_tokens",
        F.length("text").cast("long").alias("edited_chars"),
        F.col("tree.n_tokens").alias("edited_tokens"),
        "reencoded_chars",
        F.sha2("text", 256).alias("edited_sha256"),
    )


@query
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and the smallest document that it is linked with."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    groups = simhash.near_groups(simhash.with_simhash(docs, SHINGLE).drop("text"), DISTANCE)
    return groups.select(
        "doc_id",
        simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query
def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What stays of every document without the 50-byte strings of smaller ones."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cut = repeats.cut_repeats(docs.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document inside a window of a benchmark item, and those items."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    hits = decontaminate.benchmark_hits(docs, table(spark, folder, "benchmark"))
    items = F.array_sort(F.col("hits.items").cast("array<string>"))
    return hits.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


@query
def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's verdict under the rules, or else its host's path templates."""
    return urls.filter_urls(table(spark, folder, "pages"), URL_RULES)


def _digest(values: Column) -> Column:
    return F.sha2(F.array_join(values.cast("array<string>"), ","), 256)


@query
def op9_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next are."""
    made = winnow.edited_beside_next(table(spark, folder, "documents"))
    return made.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        _digest(F.col("fingerprint")).alias("fingerprint"),
        _digest(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        winnow.hashes(F.col("fingerprint")).alias("own"),
        winnow.hashes(F.col("edited_fingerprint")).alias("changed"),
        winnow.hashes(F.col("next_fingerprint")).alias("following"),
    ).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        winnow.likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        winnow.likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@query
def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to, as digests."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(docs, WORD_BPE).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


KEEP_SCORE = 0.3


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality score by trees that learned from the rows not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    trees = quality.train(docs, table(spark, folder, "labels"))
    return quality.score(docs, trees).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


PIECES = public_tokenizers.path("piece_bpe_32k.model")
MANY_LANGUAGES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document, and whether its tokens are as usual in its language and script."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "text")
    rows = fertility.with_measures(docs, PIECES, MANY_LANGUAGES, public_tokenizers.PATTERN).drop("text")
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return fertility.judged(rows).select(
        "doc_id",
        *[f"measured.{c}" for c in base],
        "verdict.base_failed",
        "verdict.kept",
        "measured.script",
        *[f"measured.{c}" for c in fertility.MEASURES],
        F.array_join("verdict.outside", ",").alias("outside"),
    )


@query
def op12_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt with the heads of their groups."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    paths = trie.with_paths(trie.with_shared_heads(trie.conversations(turns)))
    nodes = trie.prefix_trie(paths)
    digests = trie.digests_of_ids(paths.select("end", "conv_id"), "end", "conv_id")
    ended = nodes.where(F.col("end").isNotNull()).join(digests, "end").withColumnRenamed("sha256", "ends_sha256")
    passed = nodes.where(F.col("end").isNull()).withColumn("ends_sha256", F.sha2(F.lit(""), 256))
    counts = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    columns = [*counts, F.col("saved").alias("saved_tokens"), "ends_sha256"]
    return ended.select(*columns).unionByName(passed.select(*columns))


@query
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every usable embedding on the first components of all of them, each with variance one."""
    rows = whitening.usable(table(spark, folder, "embeddings").select("vec_id", "embedding"), "embedding")
    model = whitening.fit(rows)
    if model is None:
        kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], kinds)
    made = whitening.whiten(rows, model).drop("embedding")
    listed = made.select("vec_id", "deviation", F.inline(whitening.by_component(model, F.col("whitened"))))
    return listed.select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """The stages of the corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
