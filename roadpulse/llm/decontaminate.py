"""Benchmark decontamination with a positional inverted index that is distributed by document.

Every task indexes the words of its documents: for each benchmark word the sorted positions of its
postings. A window (some consecutive words of a benchmark item) is looked up from its rarest word: that
word's postings, moved by the word's offset, are intersected with those of the next rarer words until
none is left or all words stand in place. Proximity matches need the words near each other only.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, in_parts, words
from roadpulse.session import written_out

WINDOW = 10
BLOCK_ITEMS = 20_000  # benchmark items that one pass looks up; more items take more passes
BLOCK_BYTES = 32 << 20  # of words of the items of one pass, about
SEGMENT = 4_000_000  # bytes of text that are indexed at once, whole documents
#: Of each byte of a text: A-Z lower-cased, other ASCII outside words a space; bytes beyond ASCII stay.
_LETTERS = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)
) + bytes(range(128, 256))


def text_words(text: bytes) -> list[bytes]:
    """The words of a whole text in UTF-8."""
    return text.translate(_LETTERS).split()


class Queries:
    """The distinct windows of some benchmark items by their rarest word; words are numbers, rarest first.

    ``counts`` has the occurrences of each benchmark word in the documents; a window with a word that no
    document has is left out.
    """

    def __init__(self, items: list[tuple[int, list[str]]], counts: dict[str, int], window: int) -> None:
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[str, ...], set[int]] = {}
        for item, found in items:
            for at in range(max(len(found) - window, 0) + 1 if found else 0):
                owners.setdefault(tuple(found[at : at + window]), set()).add(item)
        self.windows: dict[int, list[tuple[int, list[tuple[int, int]], list[int]]]] = {}
        for run, own in owners.items():
            if all(counts.get(w) for w in run):
                numbers = [self.ids.setdefault(w.encode(), len(self.ids)) for w in run]
                order = sorted(range(len(run)), key=lambda i: (counts[run[i]], i))
                terms = [(numbers[i], i) for i in order]
                self.windows.setdefault(terms[0][0], []).append((len(run), terms, sorted(own)))


class Index:
    """Positions of known words in some documents, whose words are numbered in one line.

    Documents are parted by a place without a word, so no phrase crosses them.
    """

    def __init__(self, numbers: np.ndarray, size: int) -> None:
        known = np.flatnonzero(numbers >= 0)
        order = known[np.argsort(numbers[known], kind="stable")]
        self.ends = np.searchsorted(numbers[order], np.arange(size + 1))
        self.places, self.numbers = order, numbers

    def present(self) -> list[int]:
        """Words that have postings."""
        return np.flatnonzero(np.diff(self.ends)).tolist()

    def postings(self, word: int) -> np.ndarray:
        return self.places[self.ends[word] : self.ends[word + 1]]

    def phrase(self, terms: list[tuple[int, int]]) -> np.ndarray:
        """Places where a phrase starts; ``terms`` are (word, offset) from the rarest word on."""
        word, offset = terms[0]
        starts = self.postings(word) - offset
        starts = starts[starts >= 0]
        for word, offset in terms[1:]:
            if not len(starts):
                break
            starts = self._meet(starts, word, offset)
        return starts

    def _meet(self, starts: np.ndarray, word: int, offset: int) -> np.ndarray:
        """Intersect start places with a word's postings moved by its offset."""
        own = self.postings(word)
        if len(own) <= 4 * len(starts):
            return np.intersect1d(starts, own - offset, assume_unique=True)
        at = np.searchsorted(own, starts + offset)
        inside = at < len(own)
        starts, at = starts[inside], at[inside]
        return starts[own[at] == starts + offset]

    def near(self, terms: list[int], within: int, starts: np.ndarray) -> np.ndarray:
        """Places of the rarest word with every other word at most ``within`` places away in the document."""
        listed = sorted((self.postings(w) for w in set(terms)), key=len)
        places = listed[0]
        doc = np.searchsorted(starts, places, side="right") - 1
        low, high = np.maximum(places - within, starts[doc]), np.minimum(places + within, starts[doc + 1] - 1)
        for own in listed[1:]:
            if not len(places) or not len(own):
                return places[:0]
            at = np.searchsorted(own, low)
            there = at < len(own)
            there[there] = own[at[there]] <= high[there]
            places, low, high = places[there], low[there], high[there]
        return places


def _segments(texts: pa.Array, ids: dict[bytes, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word numbers in one line, start of each document in it) for runs of whole documents."""
    first, size, lines = 0, 0, []
    for row, value in enumerate(texts):
        text = value.as_buffer().to_pybytes() if value.is_valid and len(value.as_buffer() or b"") else b""
        found = text_words(text)
        line = np.full(len(found) + 1, -1, dtype=np.int32)
        line[:-1] = np.fromiter(map(ids.get, found, repeat(-1)), np.int32, len(found))
        lines.append(line)
        size += len(text)
        if size >= SEGMENT or row == len(texts) - 1:
            starts = np.cumsum([0, *map(len, lines)])
            yield first, np.concatenate(lines), starts
            first, size, lines = row + 1, 0, []


def _scan(queries: Queries, texts: pa.Array, within: int | None) -> Iterator[tuple[int, int, list, list, list]]:
    """(words, words hit, items found, items near, hit spans) of each text."""
    for _, numbers, starts in _segments(texts, queries.ids):
        index = Index(numbers, len(queries.ids))
        cover = np.zeros(len(numbers) + 1, dtype=np.int32)
        items: dict[int, set[int]] = {}
        close: dict[int, set[int]] = {}
        for length, terms, own in (w for word in index.present() for w in queries.windows.get(word, ())):
            found = index.phrase(terms)
            if len(found):
                np.add.at(cover, found, 1)
                np.add.at(cover, found + length, -1)
                _note(items, starts, found, own)
            if within is not None:
                _note(close, starts, index.near([w for w, _ in terms], within, starts), own)
        hit = np.cumsum(cover)[:-1] > 0
        total = np.concatenate(([0], np.cumsum(hit)))
        for doc in range(len(starts) - 1):
            a, z = int(starts[doc]), int(starts[doc + 1])
            spans = []
            if doc in items:
                step = np.diff(np.concatenate(([0], hit[a:z].view(np.int8), [0])))
                spans = list(zip(np.flatnonzero(step > 0).tolist(), np.flatnonzero(step < 0).tolist()))
            yield z - a - 1, int(total[z] - total[a]), sorted(items.get(doc, ())), sorted(close.get(doc, ())), spans


def _note(items: dict[int, set[int]], starts: np.ndarray, places: np.ndarray, own: list[int]) -> None:
    """Add the items of a window to the documents that hold the places."""
    for doc in np.unique(np.searchsorted(starts, places, side="right") - 1).tolist():
        items.setdefault(doc, set()).update(own)


_FOUND = (
    "struct<n_words:bigint,n_hit:bigint,items:array<bigint>,near_items:array<bigint>,"
    "spans:array<struct<start:int,stop:int>>>"
)


def _with_hits(
    docs: DataFrame, sent: Broadcast, text: str, out: str, within: int | None
) -> DataFrame:
    kept = [c for c in docs.columns if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = sent.value
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("n_hit", pa.int64()),
                ("items", pa.list_(pa.int64())),
                ("near_items", pa.list_(pa.int64())),
                ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            ]
        )
        for batch in in_parts(batches, 2_000):
            found = [
                {"n_words": n, "n_hit": h, "items": i, "near_items": c, "spans": [{"start": a, "stop": z} for a, z in s]}
                for n, h, i, c, s in _scan(queries, batch.column(batch.num_columns - 1), within)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], names=[*kept, out])

    own = [F.col(f"`{c}`") for c in kept]
    given = docs.select(*own, F.col(f"`{text}`").alias(free_name(docs, "text")))
    schema = docs.select(*own, F.lit(None).cast(_FOUND).alias(out)).schema
    return given.mapInArrow(run, schema)


def _counts(docs: DataFrame, vocabulary: set[str], text: str) -> dict[str, int]:
    """Occurrences in all documents of the words of one block of benchmark items."""
    sent = docs.sparkSession.sparkContext.broadcast({w.encode() for w in vocabulary})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, known = Counter(), sent.value.__contains__
        for batch in batches:
            for value in batch.column(0):
                tally.update(filter(known, text_words((value.as_py() or "").encode())))
        found = [w.decode() for w in tally]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.string()), pa.array(tally.values(), pa.int64())], names=["word", "n"]
        )

    seen = docs.select(text).mapInArrow(run, "word string, n bigint")
    return {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator()}


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    window: int = WINDOW,
    out: str = "hits",
    within: int | None = None,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """The rows with ``out``: n_words, n_hit, items, near_items and spans (start, stop in words from 0).

    A window is ``window`` consecutive words of an item, or all of a shorter item; a word inside any
    occurrence is hit. With ``within``, near_items are those with a window whose words all stand at most so
    many places from its rarest word, in any order. A null text and an item without words have none; an item with a null id is ignored.
    Rows that repeat an item's id add their windows to it. Other columns pass through; ``out`` is replaced.

    The benchmark is taken in blocks of ``block_items`` items and ``BLOCK_BYTES`` of their words, about, so that
    what is sent to the tasks has a bound, save that one item is sent whole. Where there are several, each is a
    pass over the rows, which are written with its hits before the next block is sent.
    """
    asked = benchmark.select(F.col(item).cast("bigint").alias("i"), words(F.col(text)).alias("w"))
    asked = asked.where(F.col("i").isNotNull() & (F.size("w") > 0))
    sizes = asked.agg(F.count("*"), F.sum(F.octet_length(F.array_join("w", " ")))).first()
    blocks = max(1, -(-sizes[0] // block_items), -(-(sizes[1] or 0) // BLOCK_BYTES))
    found = docs
    names = [free_name(docs, f"hits_{n}") for n in range(blocks)]
    for n, name in enumerate(names):
        block = asked.where(F.pmod(F.xxhash64("i"), F.lit(blocks)) == n) if blocks > 1 else asked
        items = [(r["i"], r["w"]) for r in block.collect()]
        counts = _counts(docs, {w for _, own in items for w in own}, text)
        sent = docs.sparkSession.sparkContext.broadcast(Queries(items, counts, window))
        found = _with_hits(found, sent, text, name, within)
        if blocks > 1:
            found = written_out(found, f"hits-{n}")
            sent.destroy()
    joined = F.col(names[0])
    for name in names[1:]:
        joined = F.struct(
            joined["n_words"].alias("n_words"),
            joined["n_hit"].alias("n_hit"),
            F.concat(joined["items"], F.col(name)["items"]).alias("items"),
            F.concat(joined["near_items"], F.col(name)["near_items"]).alias("near_items"),
            F.concat(joined["spans"], F.col(name)["spans"]).alias("spans"),
        )
    if blocks > 1:
        merged = _merged(F.array_sort(joined["spans"]))
        total = F.aggregate(merged, F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
        joined = F.struct(
            joined["n_words"].alias("n_words"),
            total.alias("n_hit"),
            F.array_sort(F.array_distinct(joined["items"])).alias("items"),
            F.array_sort(F.array_distinct(joined["near_items"])).alias("near_items"),
            merged.alias("spans"),
        )
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], joined.alias(out))


def _merged(spans: Column) -> Column:
    """Sorted spans with those that touch or overlap made one."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def add(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], s["stop"]).alias("stop"))
        apart = (F.size(acc) == 0) | (last["stop"] < s["start"])
        return F.when(apart, F.concat(acc, F.array(s))).otherwise(
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(longer))
        )

    return F.aggregate(spans, none, add)
