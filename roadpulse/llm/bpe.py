"""BPE encoding and decoding with the vocabulary of a tokenizer file.

A word's symbols form a doubly linked list; possible merges wait in a priority queue by rank and
position, and an entry whose symbols have changed since is skipped. Decoding concatenates the
vocabulary's strings. Results are those of the file's own library without special tokens added:
special tokens inside a text are found first, then the text is normalised, split and encoded.
Unicode tables differ in age: characters that Python's lack count as symbols here, and combining marks
younger than Unicode 13 are put in order here but not by the library's normaliser.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from unicodedata import category, normalize

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, with_computed

MOST_WORDS = 250_000  # chunks and words after which a task forgets those not met since the last time
_SHIFT = 20  # bits of a token id
_MASK = (1 << _SHIFT) - 1
_UNKNOWN = "\ufdd0"  # stands for any unassigned character while a text is split
_ODD_SPACES = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The printable character of each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        letters.append(chr(byte if byte in own else spare))
        spare += byte not in own
    return letters


class Vocabulary:
    """Tables of one tokenizer file (BPE over bytes with a suffix that ends each word)."""

    def __init__(self, content: str) -> None:
        spec = json.loads(content)
        model, steps = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        names = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if names != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError("not a word-level BPE file of the known kind")
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.strings = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for string, i in [*vocab.items(), *self.special.items()]:
            self.strings[i] = string
        letters = byte_letters()
        self.inner = [vocab[x] for x in letters]
        self.last = [vocab[x + suffix] for x in letters]
        self.ranks = {
            vocab[a] << _SHIFT | vocab[b]: rank << _SHIFT | vocab[a + b]
            for rank, (a, b) in enumerate(model["merges"])
        }
        self.split = regex.compile(steps[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        self.marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    def word(self, word: str) -> list[int]:
        """Token ids of one word."""
        data = word.encode()
        ids = [self.inner[x] for x in data]
        ids[-1] = self.last[data[-1]]
        n, ranks = len(ids), self.ranks
        # A queue entry is rank * n + position, so the smallest is the next merge, leftmost among equals.
        queue = []
        for i, (left, right) in enumerate(zip(ids, ids[1:])):
            found = ranks.get(left << _SHIFT | right)
            if found is not None:
                queue.append((found >> _SHIFT) * n + i)
        if not queue:
            return ids
        heapify(queue)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while queue:
            rank, i = divmod(heappop(queue), n)
            j = after[i]
            if j >= n:
                continue
            found = ranks.get(ids[i] << _SHIFT | ids[j])
            if found is None or found >> _SHIFT != rank:
                continue  # stale: one of the two symbols has been merged meanwhile
            merged = found & _MASK
            ids[i], ids[j] = merged, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                found = ranks.get(merged << _SHIFT | ids[k])
                if found is not None:
                    heappush(queue, (found >> _SHIFT) * n + i)
            h = before[i]
            if h >= 0:
                found = ranks.get(ids[h] << _SHIFT | merged)
                if found is not None:
                    heappush(queue, (found >> _SHIFT) * n + h)
        return [x for x in ids if x >= 0]


class _Chunks(dict):
    """Token ids, as bytes of int32, of chunks between white space and of words; found when first asked for."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is not None:
            pass
        elif chunk.isascii() and chunk.isalpha() and chunk.islower():
            found = array("i", self.vocabulary.word(chunk)).tobytes()
        else:
            found = b"".join([self._word(w) for w in self._words(chunk)])
        self[chunk] = found
        return found

    def _word(self, word: str) -> bytes:
        found = self.get(word) or self.older.get(word)
        if found is None:
            found = self[word] = array("i", self.vocabulary.word(word)).tobytes()
        return found

    def _words(self, chunk: str) -> list[str]:
        # Letters are lowered one by one, so a final sigma is not special.
        plain = normalize("NFC", chunk).replace("Σ", "σ").lower()
        split = self.vocabulary.split
        if plain.isascii():
            return split.findall(plain)
        # Characters that the file's library does not know yet are neither letters nor digits.
        shown = "".join(_UNKNOWN if category(c) == "Cn" else c for c in plain)
        return [plain[at.start() : at.end()] for at in split.finditer(shown)]

    def forget(self) -> None:
        if len(self) > MOST_WORDS:
            self.older = dict(self)
            self.clear()

    def encode(self, text: str) -> bytes:
        """Token ids of a whole text."""
        v, parts, at = self.vocabulary, [], 0
        if "<" in text:
            for mark in v.marks.finditer(text):
                parts += [self._plain(text[at : mark.start()]), np.int32(v.special[mark[0]]).tobytes()]
                at = mark.end()
        parts.append(self._plain(text[at:] if at else text))
        return b"".join(parts)

    def _plain(self, text: str) -> bytes:
        if _ODD_SPACES.search(text):  # str.split takes these for white space, the file's pattern doesn't
            return b"".join([self[x] for x in _SPACES.split(text) if x])
        return b"".join(map(self.__getitem__, text.split()))


def _content(df: DataFrame, path: str):
    """The file's content for the executors; its size is that of a vocabulary, a few MB."""
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def _id_lists(texts: pa.Array, chunks: _Chunks) -> pa.ListArray:
    """Token ids of each text."""
    ends, found = [0], []
    for value in texts:
        found.append(chunks.encode(value.as_py() or ""))
        ends.append(ends[-1] + len(found[-1]) // 4)
        chunks.forget()
    flat = pa.array(np.frombuffer(b"".join(found), dtype=np.int32))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)


def _decoded(lists: pa.Array, strings: np.ndarray) -> pa.Array:
    """The vocabulary's strings of each list, joined by a space."""
    texts = [" ".join(strings[x.values.to_numpy()]) if x.is_valid and len(x) else "" for x in lists]
    return pa.array(texts, pa.string())


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The rows with ``out``, the token ids (array<int>) of the whole ``text``.

    A null or empty text has no tokens. Repeated rows stay, other columns pass through; a column
    already named ``out`` is replaced. An empty table gives none. ``path`` is the tokenizer file.
    """
    content = _content(df, path)

    def start() -> Callable:
        chunks = _Chunks(Vocabulary(content.value))
        return lambda texts: _id_lists(texts, chunks)

    return with_computed(df, text, out, "array<int>", start)


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The rows with ``out``, the vocabulary's strings of ``ids`` joined by a space.

    These files name no decoder; their library then puts a space between the strings. Null or empty
    ids give an empty text. The other columns pass through; one already named ``out`` is replaced.
    """
    content = _content(df, path)

    def start() -> Callable:
        strings = np.array(Vocabulary(content.value).strings, dtype=object)
        return lambda lists: _decoded(lists, strings)

    return with_computed(df, ids, out, "string", start)


def encode_and_decode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``decode(encode(df))`` in one pass: the rows with ``ids`` and ``out``.

    One Python process per task does both; two in a row would hold two copies of the vocabulary.
    """
    content = _content(df, path)

    def start() -> Callable:
        vocabulary = Vocabulary(content.value)
        chunks, strings = _Chunks(vocabulary), np.array(vocabulary.strings, dtype=object)

        def compute(texts: pa.Array) -> pa.Array:
            lists = _id_lists(texts, chunks)
            return pa.StructArray.from_arrays([lists, _decoded(lists, strings)], ["ids", "decoded"])

        return compute

    name = free_name(df, "both")
    both = with_computed(df, text, name, "struct<ids:array<int>,decoded:string>", start)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (ids, out)]
    return both.select(*kept, F.col(f"`{name}`.ids").alias(ids), F.col(f"`{name}`.decoded").alias(out))
