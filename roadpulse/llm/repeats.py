"""Suffix-array dedup: cut every byte of a long string that also starts in a smaller document.

Sorting every suffix of the corpus in one order is not needed to find strings of ``LENGTH`` bytes. Each
window of that many bytes has an anchor, the ``GRAM``-byte string in it with the smallest hash, rightmost
among equals; equal windows have equal anchors at the same place. The windows of one anchor are a context.

1. Contexts that are equal are one class, owned by its smallest document; all other documents lose the
   class's windows. Classes are found by two 64-bit hashes, dealt by the anchor's.
2. Classes of different documents that share an anchor without being equal are dealt by anchor to
   independent groups. Each group's text is suffix-sorted by the difference cover of 3 (``suffixes``):
   sorted sample triples, recursion on their names, merge of the rest; neighbours with a common prefix of
   ``LENGTH`` bytes are equal windows, and all but the smallest document lose them.
3. The spans found are brought to the documents and cut.

An anchor that many contexts of one task share may stand in a third of all documents. Its contexts are
dealt by their own hash instead, which spreads them, and its windows are sorted one by one, dealt by their
text; of equal windows a task passes on the smallest document's alone. Every task sends a notice to the
group of such an anchor, so that its other contexts, wherever they are, go the same way.

Data between the steps travels as arrays in byte strings, one per task and group, so a row costs no more
than its bytes. Every step's result is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import in_parts, with_computed
from roadpulse.llm.suffixes import repeated_windows
from roadpulse.session import written_out

LENGTH, GRAM = 50, 24
GROUP_BYTES = 8 << 20  # text per group; the number of groups follows the size of the corpus
FLUSH = 3 << 20  # bytes of text whose anchors a task holds before it passes them on
CHUNK = 1 << 20  # windows of a text that are hashed at once
PIECE = 128 << 10  # text that is sorted at once, in whole anchors
CROWD = 24  # contexts of one anchor in a task from which it is dealt by context and sorted by window
# Rows: windows to cut; contexts dealt by anchor; contexts dealt by themselves; anchors so dealt.
CUT, ASK, CROWDED, NOTICE = range(4)

_LOW = np.uint64((1 << 24) - 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_rng = np.random.default_rng(50)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & (1 << 64) - 1, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Anchors:
    """Finds the contexts of texts; holds the tables of powers."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM) -> None:
        self.length, self.gram, self.reach = length, gram, length - gram + 1
        self.powers, self.backs = (_powers(b, CHUNK + length + 1) for b in (_BASE, _BACK))

    def contexts(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(anchor hash, context hash, first window, number of windows) per chunk of a text's bytes."""
        for at in range(0, len(data) - self.length + 1, CHUNK):
            found = self._chunk(data[at : at + CHUNK + self.length - 1])
            found[2][:] += np.uint32(at)
            yield found

    def _chunk(self, data: np.ndarray) -> tuple[np.ndarray, ...]:
        n = len(data)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data] * self.powers[:n], out=sums[1:])
        grams = n - self.gram + 1
        hashes = _mixed((sums[self.gram :] - sums[:grams]) * self.backs[:grams])
        # The place, turned round, stands in the low bits: of equal hashes the rightmost is smallest.
        least = (hashes & ~_LOW) | (_LOW - np.arange(grams, dtype=np.uint64))
        step = 1
        while 2 * step <= self.reach:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < self.reach:
            least = np.minimum(least[: step - self.reach], least[self.reach - step :])
        first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        last = np.append(first[1:], len(least))
        anchor = (_LOW - (least[first] & _LOW)).astype(np.int64)
        stop = last - 1 + self.length
        context = _mixed((sums[stop] - sums[first]) * self.backs[first] + (stop - first).astype(np.uint64))
        return hashes[anchor], context, first.astype(np.uint32), (last - first).astype(np.uint32)


def _pack(*columns: np.ndarray) -> bytes:
    """Arrays of one length as bytes; the first is stored by its differences, which compress well."""
    first = np.diff(columns[0], prepend=np.int64(0))
    return b"".join([np.int64(len(first)).tobytes(), first.tobytes(), *(c.tobytes() for c in columns[1:])])


def _unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(blob, np.int64, 1)[0]), 8, []
    for kind in ("<i8", *kinds):
        out.append(np.frombuffer(blob, kind, n, at))
        at += n * np.dtype(kind).itemsize
    out[0] = np.cumsum(out[0])
    return out


def _joined(blobs: list[bytes], *kinds: str) -> list[np.ndarray]:
    if not blobs:
        return [np.zeros(0, kind) for kind in ("<i8", *kinds)]
    return [np.concatenate(column) for column in zip(*(_unpack(b, *kinds) for b in blobs))]


def _dealt(group: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(group, packed rows) for each group; rows keep their order."""
    order = np.argsort(group, kind="stable")
    ordered = group[order]
    heads = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(order) else []
    for a, z in zip(heads, np.append(heads[1:], len(order)) if len(order) else []):
        rows = order[a:z]
        yield int(ordered[a]), _pack(*(c[rows] for c in columns))


def _spans(doc: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with those that touch or overlap made one; ordered by document and place."""
    order = np.lexsort((first, doc))
    doc, first, count = doc[order], first[order].astype(np.int64), count[order].astype(np.int64)
    if not len(doc):
        return doc, first.astype(np.uint32), count.astype(np.uint32)
    heads = np.concatenate(([True], doc[1:] != doc[:-1]))
    number = np.cumsum(heads) - 1
    base = int((first + count).max()) + 1
    stop = np.maximum.accumulate(first + count + number * base) - number * base
    start = heads.copy()
    start[1:] |= first[1:] > stop[:-1]
    at = np.flatnonzero(start)
    return doc[at], first[at].astype(np.uint32), (stop[np.append(at[1:], len(doc)) - 1] - first[at]).astype(np.uint32)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"blob": pa.binary()}
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.int64())) for c, n in zip(columns, names)], names=names)


def _find_contexts(groups: int, per: int, length: int, gram: int) -> Callable:
    """From (doc, text): contexts dealt by anchor, and marks for copies that this task sees itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, held, size = Anchors(length, gram), [], 0
        for batch in in_parts(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(text.as_buffer(), dtype=np.uint8) if text.is_valid and text.as_py() else None
                if doc is None or data is None:
                    continue
                size += len(data)
                for h, x, first, count in finder.contexts(data):
                    held.append((h, x, np.full(len(h), doc, dtype=np.int64), first, count))
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
                    pa.default_memory_pool().release_unused()
        if held:
            yield flush(held)

    def flush(held: list) -> pa.RecordBatch:
        h, x, doc, first, count = (np.concatenate(c) for c in zip(*held))
        least = _class_owner(h, x, doc // per)[0]
        copy = doc // per > least
        marks = _spans(doc[copy], first[copy], count[copy])
        rows = [(g % groups, CUT, g, b) for g, b in _dealt(marks[0] % groups, *marks)]
        anchors, which, sizes = np.unique(h[~copy], return_inverse=True, return_counts=True)
        crowded = np.zeros(len(h), dtype=bool)
        crowded[~copy] = sizes[which] >= CROWD
        few = "u1" if length - gram < 255 else "<u4"
        for kind, own, by in ((ASK, ~copy & ~crowded, h), (CROWDED, crowded, x)):
            columns = (doc[own], h[own], x[own], first[own], count[own].astype(few))
            rows += [(g, kind, g, b) for g, b in _dealt(_group(by[own], groups), *columns)]
        told = anchors[sizes >= CROWD]
        rows += [(g, NOTICE, g, b) for g, b in _dealt(_group(told, groups), told.astype(np.int64))]
        return _rows(rows, ["bucket", "kind", "target", "blob"])

    return run


def _group(hashes: np.ndarray, groups: int) -> np.ndarray:
    return (hashes % np.uint64(groups)).astype(np.int64)


def _class_owner(h: np.ndarray, x: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each context its class's smallest owner, and the smallest and largest of those of its anchor."""
    order = np.lexsort((x, h))
    a, b, o = h[order], x[order], owner[order]
    if not len(order):
        return o, o, o
    new_h = np.concatenate(([True], a[1:] != a[:-1]))
    new = new_h.copy()
    new[1:] |= b[1:] != b[:-1]
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(o, heads)
    anchors = np.flatnonzero(new_h[heads])
    which, anchor = np.cumsum(new) - 1, np.cumsum(new_h) - 1
    out = [np.empty_like(owner) for _ in range(3)]
    out[0][order] = least[which]
    out[1][order] = np.minimum.reduceat(least, anchors)[anchor]
    out[2][order] = np.maximum.reduceat(least, anchors)[anchor]
    return tuple(out)


def _judge_contexts(groups: int, per: int, length: int, gram: int) -> Callable:
    """From the contexts of some anchors: marks of windows to cut and of contexts to sort."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table["kind"].to_pylist()
        blobs, targets = table["blob"].to_pylist(), table["target"].to_pylist()
        rows = [(t, CUT, b) for k, t, b in zip(kinds, targets, blobs) if k == CUT]
        few = "u1" if length - gram < 255 else "<u4"
        told = _joined([b for k, b in zip(kinds, blobs) if k == NOTICE])[0].astype(np.uint64)
        for route in (ASK, CROWDED):
            doc, h, x, first, count = _joined([b for k, b in zip(kinds, blobs) if k == route], "<u8", "<u8", "<u4", few)
            owner = doc // per
            least, low, high = _class_owner(h, x, owner)
            cut = owner > least
            marks = _spans(doc[cut], first[cut], count[cut])
            rows += [(g, CUT, b) for g, b in _dealt(marks[0] % groups, *marks)]
            alone = np.isin(h, told) if route == ASK else np.ones(len(h), dtype=bool)
            ask = ~cut & ((low != high) | alone)
            asked = (doc[ask], h[ask], first[ask], count[ask].astype("<u4"), alone[ask].astype("u1"))
            rows += [(g, ASK, b) for g, b in _dealt(asked[0] % groups, *asked)]
        return pa.Table.from_batches([_rows(rows, ["bucket", "kind", "blob"])])

    return run


def _texts_with_marks(kinds: tuple[str, ...], each: Callable, finish: Callable) -> Callable:
    """Walks rows of (bucket, kind, blob, doc, text, ...), marks before texts within a bucket.

    ``each(batch, row, doc, bytes, marks)`` is called for every text with its own marks, sorted by
    place; ``finish()`` after each batch, and its record batches are passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        bucket, blobs, marks = None, [], None
        for batch in in_parts(batches):
            texts = batch.column(4)
            listed = zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3)))
            for row, (b, kind, blob, doc) in enumerate(listed):
                if b != bucket:
                    bucket, blobs, marks = b, [], None
                if kind is not None:
                    blobs.append(blob)
                    continue
                if marks is None:
                    marks = _joined(blobs, *kinds)
                    order = np.argsort(marks[0], kind="stable")
                    marks, blobs = [m[order] for m in marks], []
                data = texts[row].as_buffer().to_pybytes() if texts[row].is_valid and texts[row].as_py() else b""
                a, z = np.searchsorted(marks[0], (doc, doc + 1)) if doc is not None else (0, 0)
                each(state, batch, row, doc, data, [m[a:z] for m in marks[1:]])
            yield from finish(state, batch)
        yield from finish(state, None)

    start = dict
    return run


def _cut_contexts(groups: int, per: int, length: int) -> Callable:
    """The asked contexts as texts, dealt by anchor; those of crowded anchors window by window, by text."""
    limit = 3 << 20

    def each(state, batch, row, doc, data, marks):
        held, windows, cut = state.setdefault("parts", ([], {}, []))
        size = 0
        for h, first, count, alone in zip(*(m.tolist() for m in marks)):
            if not alone:
                held.append((doc, h, first, data[first : first + count - 1 + length]))
                size += count + length
                continue
            for at in range(first, first + count):
                window = data[at : at + length]
                known = windows.setdefault(window, (doc, at))
                if doc // per < known[0] // per:
                    windows[window] = (doc, at)
                    cut.append(known)
                elif doc // per > known[0] // per:
                    cut.append((doc, at))
                elif known != (doc, at):  # again in the same document: judged like the first
                    held.append((doc, xxhash.xxh64_intdigest(window), at, window))
                size += 2 * length
        state["size"] = state.get("size", 0) + size

    def finish(state, batch):
        if "parts" not in state or (batch is not None and state["size"] < limit):
            return
        held, windows, cut = state["parts"]
        state.clear()
        held += [(doc, xxhash.xxh64_intdigest(w), at, w) for w, (doc, at) in windows.items()]
        rows = []
        if cut:
            doc, at = np.array(cut, dtype=np.int64).T
            marks = _spans(doc, at, np.ones(len(at), dtype=np.int64))
            rows += [(g % groups, CUT, g, b) for g, b in _dealt(marks[0] % groups, *marks)]
        if held:
            doc, h, first, texts = zip(*held)
            doc, h, first = np.array(doc, np.int64), np.array(h, np.uint64), np.array(first, np.uint32)
            texts = np.array([*texts, None], dtype=object)[:-1]
            bucket = _group(h, groups)
            order = np.argsort(bucket, kind="stable")
            heads = np.flatnonzero(np.concatenate(([True], np.diff(bucket[order]) != 0)))
            for a, z in zip(heads, np.append(heads[1:], len(order))):
                own = order[a:z]
                sizes = np.array([len(t) for t in texts[own]], dtype=np.uint32)
                packed = _pack(doc[own], h[own], first[own], sizes) + b"".join(texts[own])
                rows.append((int(bucket[own[0]]), ASK, int(bucket[own[0]]), packed))
        if rows:
            yield _rows(rows, ["bucket", "kind", "target", "blob"])

    return _texts_with_marks(("<u8", "<u4", "<u4", "u1"), each, finish)


def _pieces(h: np.ndarray, size: np.ndarray) -> Iterator[slice]:
    """Runs of texts of about ``PIECE`` bytes that hold all texts of an anchor; ``h`` is sorted."""
    heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    before = np.cumsum(size) - size
    part = before[heads] // PIECE
    first = heads[np.concatenate(([True], part[1:] != part[:-1]))]
    for a, z in zip(first, np.append(first[1:], len(h))):
        yield slice(a, z)


def _sort_contexts(groups: int, per: int, length: int) -> Callable:
    """From the contexts of some anchors: marks of windows that a smaller document has too."""

    def run(table: pa.Table) -> pa.Table:
        columns, texts, rows = [], [], []
        for kind, target, blob in zip(*(table[c].to_pylist() for c in ("kind", "target", "blob"))):
            if kind == CUT:
                rows.append((target, CUT, blob))
                continue
            columns.append(_unpack(blob, "<u8", "<u4", "<u4"))
            texts.append(blob[8 + 24 * len(columns[-1][0]) :])
        if not columns:
            return pa.Table.from_batches([_rows(rows, ["bucket", "kind", "blob"])])
        doc, h, first, size = (np.concatenate(c) for c in zip(*columns))
        owner = doc // per
        # Equal texts are one class: the smallest owner's is sorted, what others have of it goes whole.
        joined, classes = b"".join(texts), {}
        stops = np.cumsum(size, dtype=np.int64)
        bounds = zip((stops - size).tolist(), stops.tolist())
        which = np.array([classes.setdefault(joined[a:z], len(classes)) for a, z in bounds], dtype=np.int64)
        least = np.full(len(classes), np.iinfo(np.int64).max)
        np.minimum.at(least, which, owner)
        cut = owner > least[which]
        found = [_spans(doc[cut], first[cut], size[cut] - np.uint32(length - 1))]
        listed, hashes = list(classes), np.zeros(len(classes), dtype=np.uint64)
        hashes[which] = h
        order = np.argsort(hashes, kind="stable")
        lengths = np.array([len(t) for t in listed], dtype=np.int64)
        stays = np.flatnonzero(~cut)
        stays = stays[np.argsort(which[stays], kind="stable")]
        starts = np.searchsorted(which[stays], np.arange(len(listed) + 1))
        for own in _pieces(hashes[order], lengths[order]):
            chosen = order[own]
            part = np.frombuffer(b"".join(listed[i] for i in chosen.tolist()), dtype=np.uint8)
            text, place = repeated_windows(part, lengths[chosen], least[chosen], length)
            # Back from a class to all its texts in the owner's rows.
            kind = chosen[text]
            times = starts[kind + 1] - starts[kind]
            at = np.repeat(starts[kind], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            own_rows = stays[at]
            windows = first[own_rows].astype(np.int64) + np.repeat(place, times)
            found.append(_spans(doc[own_rows], windows, np.ones(len(windows), np.int64)))
        marks = [np.concatenate(c) for c in zip(*found)]
        rows += [(g, CUT, b) for g, b in _dealt(marks[0] % groups, *marks)]
        return pa.Table.from_batches([_rows(rows, ["bucket", "kind", "blob"])])

    return run


def _cut_texts(kept: list[str], kept_bytes: str, spans: str, length: int) -> Callable:
    """The documents without the marked windows' bytes."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def each(state, batch, row, doc, data, marks):
        first, count = marks
        _, a, n = _spans(np.zeros(len(first), np.int64), first, count + np.uint32(length - 1))
        cuts = [(int(x), int(x) + int(y)) for x, y in zip(a, n)]
        parts, at = [], 0
        for x, y in cuts:
            parts.append(data[at:x])
            at = y
        parts.append(data[at:])
        state.setdefault("rows", []).append((row, b"".join(parts), [{"start": x, "stop": y} for x, y in cuts]))

    def finish(state, batch):
        rows = state.pop("rows", [])
        if rows:
            own = pa.array([r[0] for r in rows])
            columns = [batch.column(5 + i).take(own) for i in range(len(kept))]
            made = [pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], span)]
            yield pa.RecordBatch.from_arrays([*columns, *made], names=[*kept, kept_bytes, spans])

    return _texts_with_marks(("<u4", "<u4"), each, finish)


def _step(df: DataFrame, label: str) -> DataFrame:
    """Write a step's result; its shuffle files are not needed after that and are removed.

    Texts go to Python in smaller batches meanwhile, which hold less memory on both sides.
    """
    conf = df.sparkSession.conf
    wanted = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    }
    before = {name: conf.get(name) for name in wanted}
    for name, value in wanted.items():
        conf.set(name, value)
    try:
        return written_out(df, label)
    finally:
        for name, value in before.items():
            conf.set(name, value)


def _numbered(docs: DataFrame, key: str, text: str, passing: list[str]) -> tuple[DataFrame, int, int]:
    """(d, t, c0, c1, ...): a number per (key, text), the text, and the columns ``passing`` by their place.

    Also how many numbers a key has, and the bytes of all texts. The number is the key itself unless a key
    stands with different texts.
    """
    named = docs.select(
        F.col(f"`{key}`").cast("bigint").alias("d"),
        F.col(f"`{text}`").alias("t"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(passing)],
    )
    own = named.select(F.col("d").alias("k"), F.xxhash64("t").alias("h"), F.coalesce(F.octet_length("t"), F.lit(0)).alias("n"))
    known = own.groupBy("k").agg(F.min("h").alias("a"), F.max("h").alias("z"), F.sum("n").alias("n"))
    repeated = F.max((F.col("k").isNotNull() & (F.col("a") != F.col("z"))).cast("int"))
    total = known.agg(F.sum("n").alias("n"), repeated.alias("r"), F.max("k").alias("high"), F.min("k").alias("low")).first()
    if not total["r"]:
        return named, 1, total["n"] or 0
    several = own.where("k is not null").select("k", "h").distinct()
    several = several.groupBy("k").agg(F.array_sort(F.collect_set("h")).alias("hashes")).where(F.size("hashes") > 1)
    several = _step(several, "texts-of-one-id")
    per = several.agg(F.max(F.size("hashes"))).first()[0]
    if max(abs(total["high"]), abs(total["low"])) + 1 > (1 << 62) // per:
        raise ValueError(f"{key} is too large for rows that share one: {per} texts have the same")
    joined = named.join(several, F.col("d") == F.col("k"), "left")
    at = F.coalesce(F.array_position("hashes", F.xxhash64("t")), F.lit(1)) - 1
    return joined.withColumn("d", F.col("d") * per + at).drop("k", "hashes"), per, total["n"] or 0


def _prime(n: int) -> int:
    while n < 3 or any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def cut_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    kept: str = "kept",
    spans: str = "spans",
) -> DataFrame:
    """The rows without ``text``, with ``kept`` (the bytes that stay) and ``spans`` (runs cut: start, stop).

    A byte goes if a string of ``length`` bytes that covers it also starts in a row with a smaller key;
    strings are compared in the given texts and never cross rows. A null or empty text keeps no bytes
    and has no spans. A row with a null key is compared with none and stays whole. Rows that share a key
    do not cut each other; those that repeat a row are cut alike. Keys are whole numbers; where one
    stands with several texts, their product must fit 62 bits, else it is an error. Very long texts are cut like
    others. Other columns pass through, whatever their names; ``kept`` and ``spans`` are replaced. No rows give no rows.
    """
    spark = docs.sparkSession
    passing = [c for c in docs.columns if c not in (text, kept, spans)]
    rows, per, size = _numbered(docs, key, text, passing)
    groups = _prime(max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // GROUP_BYTES))
    texts = rows.select("d", "t")

    dealt = "bucket bigint, kind bigint, target bigint, blob binary"
    found = texts.mapInArrow(_find_contexts(groups, per, length, gram), dealt)
    marks = "bucket bigint, kind bigint, blob binary"
    judged = _step(found.repartition(groups, "bucket").groupBy("bucket").applyInArrow(_judge_contexts(groups, per, length, gram), marks), "marks")

    def beside(own: DataFrame, more: int) -> DataFrame:
        """Marks and texts by bucket, marks first; the first ``more`` of the passing columns go along."""
        here = rows.select(
            F.coalesce(F.pmod("d", F.lit(groups)), F.pmod(F.xxhash64("t"), F.lit(groups))).alias("b"),
            F.lit(None).cast("bigint").alias("kind"),
            F.lit(None).cast("binary").alias("blob"),
            "d",
            "t",
            *[f"c{i}" for i in range(more)],
        )
        there = own.select(F.col("bucket").alias("b"), "kind", "blob")
        both = there.unionByName(here, allowMissingColumns=True)
        names = ["b", "kind", "blob", "d", "t", *[f"c{i}" for i in range(more)]]
        return both.select(*names).repartition(groups, "b").sortWithinPartitions("b", F.col("kind").asc_nulls_last())

    asked = beside(judged.where(F.col("kind") == ASK), 0)
    cut = asked.mapInArrow(_cut_contexts(groups, per, length), dealt)
    sorted_ = _step(cut.repartition(groups, "bucket").groupBy("bucket").applyInArrow(_sort_contexts(groups, per, length), marks), "sorted")

    out = docs.select(
        *[F.col(f"`{c}`") for c in passing],
        F.lit(None).cast("binary").alias(kept),
        F.lit(None).cast("array<struct<start:bigint,stop:bigint>>").alias(spans),
    ).schema
    every = beside(judged.where(F.col("kind") == CUT).unionByName(sorted_), len(passing))
    return every.mapInArrow(_cut_texts(passing, kept, spans, length), out)


def whole_characters(df: DataFrame, kept: str = "kept", out: str = "text") -> DataFrame:
    """The rows with ``out``, the text of the bytes in ``kept``; of a character that a cut parted nothing stays."""

    def start() -> Callable:
        return lambda blobs: pa.array([(x.as_py() or b"").decode("utf-8", "ignore") for x in blobs], pa.string())

    return with_computed(df, kept, out, "string", start)
