"""Quality rules by tokeniser fertility: how public vocabularies cut a text, judged per language and script.

Four measures of a whole text: code points of its words per piece of a vocabulary with byte fallback; code
points per token of a byte-level vocabulary; the share of pieces that are single bytes; and the entropy of
its pieces in bits. Words are cut one by one, so a task remembers the words it has met, and texts of any
length need memory for their words only. Entropy grows with length, so it is compared among texts whose
number of pieces lies between the same powers of two.

Bands come from all texts that pass the base rules, copies of a text counted once: per language and script,
and per script alone, a histogram of each measure gives its quartiles, and a band reaches ``FENCE``
interquartile ranges (or the least width stated) beyond them. A text outside the band of a measure is
rejected. A group of fewer than ``LEAST_TEXTS`` texts has no bands of its own; its texts go by those of their
script, and where that is rare too they are kept. The script is that of most code points in words.

A null text has no words; a text without words, or under 50, fails the base rules and fits no band. A null or
empty language goes by script alone. Repeated rows each get the same result. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, with_computed
from roadpulse.session import written_out

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

MOST_WORDS = 200_000  # words after which a task forgets those it has met
LONG_WORD = 1_000  # longer words are cut in parts of so many code points
MEASURES = ["chars_per_piece", "chars_per_token", "byte_share", "entropy"]
STEPS = {"chars_per_piece": 100, "chars_per_token": 100, "byte_share": 1_000, "entropy": 100}  # bins per unit
LEAST_WIDTH = {"chars_per_piece": 0.3, "chars_per_token": 0.3, "byte_share": 0.02, "entropy": 0.4}
FENCE = 3.0
LEAST_TEXTS = 50
MOST_GROUPS = 10_000  # whose bands are broadcast; more are joined by shuffling

MEASURED = (
    "struct<n_words:bigint,word_chars:bigint,n_symbols:bigint,n_dup_lines:bigint,n_repeat_words:bigint,"
    "n_pieces:bigint,chars_per_piece:double,chars_per_token:double,byte_share:double,entropy:double,"
    "script:string,digest:binary>"
)


class Vocabularies:
    """How words are cut: pieces of one vocabulary, and how many tokens another makes."""

    def __init__(self, pieces: bytes, ranks: bytes, pattern: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.tokens = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.size = self.pieces.get_piece_size()
        self.single = np.array([self.pieces.is_byte(i) for i in range(self.size)], dtype=np.int64)
        self.names: dict[str, str] = {}

    def cut(self, words: list[str]) -> Iterator[tuple[list[int], int]]:
        """(pieces, number of tokens) of each word; one without pieces counts as unknown."""
        parts = [[w] if len(w) <= LONG_WORD else [w[i : i + LONG_WORD] for i in range(0, len(w), LONG_WORD)] for w in words]
        cut = iter(self.pieces.encode([p for own in parts for p in own], num_threads=1))
        count = self.tokens.encode_ordinary
        for own in parts:
            found = next(cut) if len(own) == 1 else [i for _ in own for i in next(cut)]
            tokens = len(count(" " + own[0])) + sum(len(count(p)) for p in own[1:])
            yield found or [self.pieces.unk_id()], tokens

    def script(self, word: str) -> str:
        """Script of a word's first letter that tells one, by the letter's Unicode name; empty without letters."""
        if word.isascii():
            return "LATIN" if any(map(str.isalpha, word)) else ""
        for letter in word:
            if letter.isalpha():
                found = self.names.get(letter)
                if found is None:
                    found = self.names[letter] = unicodedata.name(letter, "UNNAMED").split(" ")[0]
                return found
        return ""


class Words:
    """The words a task has met, as numbers; their pieces lie in one flat array."""

    def __init__(self, vocabularies: Vocabularies) -> None:
        self.vocabularies = vocabularies
        self.scripts: dict[str, int] = {"": 0}
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.chars, self.tokens, self.script = array("q"), array("q"), array("q")
        self.flat, self.ends = array("q"), array("q", [0])

    def known(self, words: list[str]) -> np.ndarray:
        """Numbers of words."""
        numbers = self.numbers
        new = [w for w in dict.fromkeys(words) if w not in numbers]
        for word, (ids, tokens) in zip(new, self.vocabularies.cut(new)):
            numbers[word] = len(numbers)
            self.chars.append(len(word))
            self.tokens.append(tokens)
            self.script.append(self.scripts.setdefault(self.vocabularies.script(word), len(self.scripts)))
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
        return np.array([numbers[w] for w in words], dtype=np.int64)


def _counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of their weights."""
    found, at = np.unique(keys, return_inverse=True)
    return found, np.bincount(at, weights, len(found)).astype(np.int64)


def repeated_words(doc: np.ndarray, word: np.ndarray, docs: int) -> np.ndarray:
    """Per text the words that lie in a window of three that its text has twice or more.

    ``doc`` and ``word`` are numbers, a pair per word of all texts in order.
    """
    n = len(word)
    inside = np.flatnonzero(doc[:-2] == doc[2:]) if n > 2 else np.zeros(0, np.int64)
    hit = np.zeros(n, dtype=bool)
    if len(inside):
        pair = np.unique(word[:-1] * (word.max() + 1) + word[1:], return_inverse=True)[1]
        triple = np.unique(pair[inside] * (word.max() + 1) + word[inside + 2], return_inverse=True)[1]
        _, at, times = np.unique(doc[inside] * (triple.max() + 1) + triple, return_inverse=True, return_counts=True)
        places = inside[times[at] > 1]
        for k in range(3):
            hit[places + k] = True
    return np.bincount(doc[hit], minlength=docs)


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def measured(texts: pa.Array, words: Words) -> pa.StructArray:
    """Base counts and measures of texts; see ``MEASURED``."""
    docs, texts = len(texts), pc.fill_null(texts, "")
    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    doc = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.list_flatten(parts).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    distinct = coded.dictionary.to_pylist()
    empty = next((i for i, w in enumerate(distinct) if not w), None)
    if empty is not None:
        doc, code = doc[code != empty], code[code != empty]
        distinct[empty] = "x"  # stands for the parts between blanks, which no place has any more
    number = words.known(distinct)
    word = number[code]

    chars, tokens, script, ends, flat = (
        np.frombuffer(x, np.int64) for x in (words.chars, words.tokens, words.script, words.ends, words.flat)
    )
    per = np.bincount(doc, minlength=docs)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, values[word], docs).astype(np.int64)

    # Pieces of each text: words first, as a text repeats many of them.
    pairs, times = _counted(doc * len(chars) + word, np.ones(len(word)))
    owner, one = np.divmod(pairs, max(len(chars), 1))
    length = ends[one + 1] - ends[one]
    place = np.repeat(ends[one] - np.concatenate([[0], np.cumsum(length)[:-1]])[: len(one)], length) + np.arange(length.sum())
    piece = flat[place]
    size = words.vocabularies.size
    keys, counts = _counted(np.repeat(owner, length) * size + piece, np.repeat(times, length))
    of_doc, piece = np.divmod(keys, size)
    pieces = np.bincount(of_doc, counts, docs)
    single = np.bincount(of_doc, counts * words.vocabularies.single[piece], docs)
    spread = np.bincount(of_doc, counts * np.log2(counts), docs)

    kinds = len(words.scripts)
    letters = np.bincount(doc * kinds + script[word], chars[word], docs * kinds).reshape(docs, kinds)
    letters[:, 0] = 0.5  # no script only where there is no letter
    names = list(words.scripts)
    word_chars = total(chars)
    with np.errstate(divide="ignore", invalid="ignore"):
        measures = [word_chars / pieces, word_chars / total(tokens), single / pieces, np.log2(pieces) - spread / pieces]
    given = texts.to_pylist()
    if len(words.numbers) > MOST_WORDS:
        words.forget()
    none = per == 0
    columns = {
        "n_words": per,
        "word_chars": word_chars,
        "n_symbols": [sum(map(t.count, SYMBOLS)) for t in given],
        "n_dup_lines": [_duplicate_lines(t) for t in given],
        "n_repeat_words": repeated_words(doc, word, docs),
        "n_pieces": pieces.astype(np.int64),
        **{name: pa.array(values, pa.float64(), mask=none) for name, values in zip(MEASURES, measures)},
        "script": pa.array([names[i] for i in letters.argmax(axis=1)], pa.string()),
        "digest": pa.array([hashlib.blake2b(t.encode(), digest_size=16).digest() for t in given], pa.binary()),
    }
    return pa.StructArray.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.int64()) for x in columns.values()], list(columns))


def with_measures(df: DataFrame, pieces: str, ranks: str, pattern: str, text: str = "text", out: str = "measured") -> DataFrame:
    """The rows with ``out``, a struct ``MEASURED`` of the whole ``text``.

    ``pieces`` is a file with byte fallback, ``ranks`` and ``pattern`` are those of a byte-level vocabulary. Other
    columns pass through, whatever their names; one already named ``out`` is replaced.
    """
    contents = []
    for path in (pieces, ranks):
        with open(path, "rb") as file:
            contents.append(file.read())
    sent = df.sparkSession.sparkContext.broadcast(contents)  # files of a vocabulary, about a MB

    def start() -> Callable:
        words = Words(Vocabularies(*sent.value, pattern))
        return lambda texts: measured(texts, words)

    return with_computed(df, text, out, MEASURED, start)


def base_failed(measured: Column) -> Column:
    """Too few words, or too many of them in repeated windows of three."""
    n = measured["n_words"]
    return (n < LEAST_WORDS) | (measured["n_repeat_words"] * 100 > n * MOST_REPEATED)


def _groups(lang: Column, script: Column) -> tuple[Column, Column]:
    """(language and script, script alone); the first is null without a language."""
    own = F.lower(F.trim(lang))
    return F.when(own != "", F.concat(own, F.lit("/"), script)), script


def _band_name(measure: str, measured: Column) -> Column:
    """Which band of a group a text's measure goes by."""
    if measure != "entropy":
        return F.lit(measure)
    return F.concat(F.lit("entropy/"), F.floor(F.log2(measured["n_pieces"])).cast("string"))


def bands(rows: DataFrame, lang: str = "lang", measured: str = "measured") -> DataFrame:
    """(group, bands): per group a map from a band's name to its low and high end, over all ``rows``.

    ``rows`` are those of ``with_measures``.
    """
    m = F.col(f"`{measured}`")
    own, script = _groups(F.col(f"`{lang}`"), m["script"])
    fits = rows.where(~base_failed(m) & (m["script"] != ""))
    once = fits.groupBy(own.alias("own"), script.alias("script"), m["digest"].alias("digest")).agg(F.first(m).alias("m"))
    entries = F.array(
        *[
            F.struct(
                _band_name(name, F.col("m")).alias("band"),
                F.floor(F.col("m")[name] * STEPS[name]).alias("bin"),
                F.lit(1.0 / STEPS[name]).alias("step"),
                F.lit(LEAST_WIDTH[name]).alias("least"),
            )
            for name in MEASURES
        ]
    )
    listed = once.select(F.array_compact(F.array("own", "script")).alias("groups"), entries.alias("e"))
    listed = listed.select(F.explode("groups").alias("group"), "e").select("group", F.inline("e"))
    counts = listed.groupBy("group", "band", "bin", "step", "least").agg(F.count("*").alias("n"))
    whole = Window.partitionBy("group", "band")
    so_far = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"upto": F.sum("n").over(so_far), "all": F.sum("n").over(whole)})
    quartile = [F.min(F.when(F.col("upto") * 4 >= F.col("all") * k, F.col("bin"))) for k in (1, 3)]
    edges = counts.groupBy("group", "band").agg(
        (quartile[0] * F.first("step")).alias("q1"),
        ((quartile[1] + 1) * F.first("step")).alias("q3"),
        F.first("least").alias("least"),
        F.first("all").alias("all"),
    )
    width = F.greatest(F.lit(FENCE) * (F.col("q3") - F.col("q1")), F.col("least"))
    ends = F.struct((F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))
    known = edges.where(F.col("all") >= LEAST_TEXTS).groupBy("group")
    return known.agg(F.map_from_entries(F.collect_list(F.struct("band", ends))).alias("bands"))


def judged(rows: DataFrame, lang: str = "lang", measured: str = "measured", out: str = "verdict") -> DataFrame:
    """The rows of ``with_measures`` with ``out``: base_failed, outside (the measures out of band) and kept.

    Measures every row before it judges any: the rows are written to the shared folder.
    """
    rows = written_out(rows, "measured")
    found = written_out(bands(rows, lang, measured), "bands")
    few = found.count() <= MOST_GROUPS
    m = F.col(f"`{measured}`")
    given, joined = rows.columns, rows
    keys = dict(zip(("own", "script"), _groups(F.col(f"`{lang}`"), m["script"])))
    names = {}
    for kind, key in keys.items():
        group, names[kind] = free_name(joined, f"{kind}_group"), free_name(joined, f"{kind}_bands")
        side = found.select(F.col("group").alias(group), F.col("bands").alias(names[kind]))
        joined = joined.join(F.broadcast(side) if few else side, key == F.col(f"`{group}`"), "left").drop(group)

    def outside(name: str) -> Column:
        band = _band_name(name, m)
        ends = F.coalesce(*[F.try_element_at(F.col(f"`{names[kind]}`"), band) for kind in keys])
        return F.when((m[name] < ends["low"]) | (m[name] > ends["high"]), F.lit(name))

    failed = base_failed(m)
    reasons = F.array_compact(F.array(*[outside(name) for name in MEASURES]))
    verdict = F.struct(failed.alias("base_failed"), reasons.alias("outside"), (~failed & (F.size(reasons) == 0)).alias("kept"))
    return joined.select(*[F.col(f"`{c}`") for c in given if c != out], verdict.alias(out))
