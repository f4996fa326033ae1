import base64
import collections
import math
import re

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from roadpulse.llm import fertility, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def libraries():
    with open(queries.MANY_LANGUAGES, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    tokens = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return sentencepiece.SentencePieceProcessor(model_file=queries.PIECES), tokens


def base(text):
    """(words, their code points, symbols, duplicate lines, words in repeated windows of three)."""
    words = WORD.findall(text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines, seen, copies = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(hit)


def measures(text, libraries):
    pieces, tokens = libraries
    ids, n = [], 0
    for word in WORD.findall(text):
        for i in range(0, len(word), fertility.LONG_WORD):
            part = word[i : i + fertility.LONG_WORD]
            ids += pieces.encode(part)
            n += len(tokens.encode_ordinary(part if i else " " + part))
    chars = sum(map(len, WORD.findall(text)))
    shares = [c / len(ids) for c in collections.Counter(ids).values()]
    single = sum(map(pieces.is_byte, ids)) / len(ids)
    return chars / len(ids), chars / n, single, -sum(p * math.log2(p) for p in shares)


def with_measures(rows):
    return fertility.with_measures(rows, queries.PIECES, queries.MANY_LANGUAGES, public_tokenizers.PATTERN)


ODD = [None, "", " \t\n", "a", "a a a a", "\x1c\x85  x　y", "#*$%&|<> " * 3, "x\n\nx\n x\nx\r\nx\n", "💡😀 mañana 漢字かな", "\x00 \x01"]


def test_counts_and_measures_equal_brute_force(spark, small, prose, libraries):
    given = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").limit(60).collect()]
    texts = [*ODD, *prose, *given, "w" * 5_000, "漢" * 2_500 + " z", "one two three four " * 20_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string").repartition(3)
    for r in with_measures(rows).collect():
        text, m = texts[r["k"]] or "", r["measured"]
        counts = tuple(m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert counts == base(text)
        if m["n_words"] and "\x00" not in text:
            assert [m[c] for c in fertility.MEASURES] == pytest.approx(measures(text, libraries))
        elif not m["n_words"]:
            assert [m[c] for c in fertility.MEASURES] == [None] * 4


@pytest.mark.parametrize("texts", [[None], ["", None], ["  \n"], [" x", "x y z", " w  x\tv", "v u"], ["y x ", "x", None, "", "z"]])
def test_batches_with_few_words(libraries, texts):
    """Blanks at the ends stand beside words that look like their stand-in; also in a task's later batches."""
    with open(queries.PIECES, "rb") as a, open(queries.MANY_LANGUAGES, "rb") as b:
        words = fertility.Words(fertility.Vocabularies(a.read(), b.read(), public_tokenizers.PATTERN))
    for _ in range(2):
        for text, m in zip(texts, fertility.measured(pa.array(texts, pa.string()), words).to_pylist()):
            counts = tuple(m[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert counts == base(text or "")
            assert [m[c] for c in fertility.MEASURES] == (pytest.approx(measures(text, libraries)) if counts[0] else [None] * 4)


def test_a_task_that_forgets_gives_the_same(spark, prose, monkeypatch):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(prose * 3)], "k int, text string").coalesce(1)
    want = {r["k"]: r["measured"] for r in with_measures(rows).collect()}
    conf = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(fertility, "MOST_WORDS", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert {r["k"]: r["measured"] for r in with_measures(rows).collect()} == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", conf)


def bands_by_hand(rows):
    """{(group, band): (low, high)} from the measured rows."""
    seen, groups = set(), collections.defaultdict(list)
    for r in rows:
        m, lang = r["measured"], (r["lang"] or "").strip().lower()
        if m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"] or not m["script"]:
            continue
        for group in ([f"{lang}/{m['script']}"] if lang else []) + [m["script"]]:
            if (lang, group, m["digest"]) in seen:
                continue
            seen.add((lang, group, m["digest"]))
            for name in fertility.MEASURES:
                band = f"entropy/{m['n_pieces'].bit_length() - 1}" if name == "entropy" else name
                groups[group, band].append((math.floor(m[name] * fertility.STEPS[name]), name))
    out = {}
    for key, values in groups.items():
        n, name = len(values), values[0][1]
        if n >= fertility.LEAST_TEXTS:
            bins, step = sorted(b for b, _ in values), 1.0 / fertility.STEPS[name]
            q1, q3 = bins[-(-n // 4) - 1] * step, (bins[-(-3 * n // 4) - 1] + 1) * step
            width = max(fertility.FENCE * (q3 - q1), fertility.LEAST_WIDTH[name])
            out[key] = (q1 - width, q3 + width)
    return out


def test_bands_and_verdicts_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text")
    lang = F.when(F.col("doc_id") % 7 == 0, F.lit(None)).when(F.col("doc_id") % 7 == 1, " EN ").otherwise(F.col("lang"))
    rows = with_measures(docs.withColumn("lang", lang)).drop("text")
    judged = fertility.judged(rows).collect()
    known = bands_by_hand(judged)
    found = {(r["group"], name): (b["low"], b["high"]) for r in fertility.bands(rows).collect() for name, b in r["bands"].items()}
    flat = [{(*k, i): x for k, ends in table.items() for i, x in enumerate(ends)} for table in (found, known)]
    assert flat[0] == pytest.approx(flat[1])
    rejected = 0
    for r in judged:
        m, lang, v = r["measured"], (r["lang"] or "").strip().lower(), r["verdict"]
        failed = m["n_words"] < 50 or 2 * m["n_repeat_words"] > m["n_words"]
        out = []
        for name in fertility.MEASURES if m["n_words"] else []:
            band = f"entropy/{m['n_pieces'].bit_length() - 1}" if name == "entropy" else name
            low, high = known.get((f"{lang}/{m['script']}", band)) or known.get((m["script"], band)) or (-1, 1e9)
            if not low <= m[name] <= high:
                out.append(name)
        assert (v["base_failed"], list(v["outside"]), v["kept"]) == (failed, out, not failed and not out)
        rejected += bool(out and not failed)
    assert rejected > 20


def test_junk_is_rejected_and_clean_text_is_kept(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op11_quality_rules(spark, folder).join(labels, "doc_id").where(~F.col("base_failed")).collect()
    clean, junk = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.25 * len(junk)


def test_rare_scripts_are_kept_and_copies_do_not_move_bands(spark):
    plain = [(i, "en", " ".join(f"word{(i * 7 + 13 * k) % 400} and" for k in range(60))) for i in range(80)]
    rows = [*plain, *[(1_000 + i, "en", "ODD! " + " ".join(f"Z{k}Q" for k in range(70))) for i in range(300)]]
    rows += [(2_000, "ru", " ".join(f"слово{k}" for k in range(80)))]
    made = fertility.judged(with_measures(spark.createDataFrame(rows, "doc_id long, lang string, text string"))).collect()
    verdicts = {r["doc_id"]: r["verdict"] for r in made}
    assert all(verdicts[i]["kept"] for i in range(80)) and verdicts[2_000]["kept"]
    assert not any(verdicts[1_000 + i]["kept"] for i in range(300))


def test_clashing_names_and_empty_table(spark, prose):
    rows = spark.createDataFrame([(i, "en", t, 1, 2, 3, 4) for i, t in enumerate(prose)], "doc_id long, lang string, text string, own_group int, bands int, Source int, n_words int")
    made = fertility.judged(with_measures(rows))
    assert made.columns == [*rows.columns, "measured", "verdict"]
    assert {tuple(r[3:7]) for r in made.collect()} == {(1, 2, 3, 4)}
    assert fertility.judged(with_measures(rows.limit(0))).collect() == []
