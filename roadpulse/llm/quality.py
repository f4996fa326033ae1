"""Quality classifier: histogram gradient-boosted trees over statistics of a document's text.

Training runs on a bounded sample of labelled rows (``rows`` of ``train``). Statistics and scores
cover every document and run in the tasks; the trees are flat arrays that are walked for all rows
and trees at once.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import with_computed

TRAIN_ROWS = 20_000  # at most so many labelled documents train the trees; 8 MB on the driver
BINS, ROUNDS, LEVELS, RATE, WEIGHT, LEAST = 64, 120, 4, 0.12, 1.0, 4.0
_SCALE = 1_000_000

_SYMBOLS = np.array([ord(c) for c in string.punctuation])
STATISTICS = [
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "space", "beyond_ascii",
    "control", "entropy", "distinct_words", "top_word", "short_words", "upper_words", "no_letter_words",
    "marked_words", "repeats_next", "log_lines", "line_length", "distinct_lines", "repeated_line_chars",
    "unended_lines", "longest_run", *[f"symbol_{c}" for c in string.punctuation],
]


def text_statistics(text: str) -> np.ndarray:
    """The statistics of one whole text; zeros for an empty one."""
    out = np.zeros(len(STATISTICS))
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if not len(data):
        return out
    n = len(data)
    count = np.bincount(data, minlength=256)
    share = count / n
    parts = text.split()
    tally = Counter(parts)
    lines = [x.strip() for x in text.split("\n")]
    lines = [x for x in lines if x]
    per_line = Counter(lines)
    w, k = max(len(parts), 1), max(len(lines), 1)
    seen = share[share > 0]
    jumps = np.flatnonzero(data[1:] != data[:-1])
    edges = np.concatenate(([-1], jumps, [n - 1]))
    out[:23] = (
        np.log1p(len(text)),
        np.log1p(len(parts)),
        len(text) / w,
        np.log1p(max(map(len, tally), default=0)),
        share[65:91].sum(),
        share[48:58].sum(),
        share[9:14].sum() + share[32],
        share[128:].sum(),
        share[:9].sum() + share[14:32].sum(),
        -(seen * np.log2(seen)).sum(),
        len(tally) / w,
        max(tally.values(), default=0) / w,
        sum(c for x, c in tally.items() if len(x) <= 3) / w,
        sum(c for x, c in tally.items() if x.isupper()) / w,
        sum(c for x, c in tally.items() if not any(map(str.isalpha, x))) / w,
        sum(c for x, c in tally.items() if not x[-1].isalnum()) / w,
        sum(map(str.__eq__, parts, parts[1:])) / w,
        np.log1p(len(lines)),
        len(text) / k,
        len(per_line) / k,
        sum(len(x) * c for x, c in per_line.items() if c > 1) / n,
        sum(c for x, c in per_line.items() if x[-1] not in ".!?:;") / k,
        np.log1p(np.diff(edges).max()),
    )
    out[23:] = share[_SYMBOLS]
    return out


def statistics(df: DataFrame, text: str = "text", out: str = "statistics") -> DataFrame:
    """The rows with ``out``, the statistics of every whole text in the order of STATISTICS.

    A null or empty text has zeros. Other columns pass through; one already named ``out`` is replaced.
    """

    def start() -> Callable:
        def compute(texts: pa.Array) -> pa.Array:
            # A text at a time; a batch's texts are not all Python strings at once.
            rows = [text_statistics(x.as_py() or "") for x in texts]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * len(STATISTICS)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))

        return compute

    return with_computed(df, text, out, "array<double>", start)


@dataclass
class Trees:
    """Boosted trees as flat arrays; node 0 of tree t is ``roots[t]``, a leaf points to itself."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each row of statistics."""
        if not len(x):
            return np.zeros(0)
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(LEVELS if len(self.roots) else 0):
            at = np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost trees of ``LEVELS`` levels on binned statistics under the logistic loss.

    Without rows the score is one half everywhere; with one label only, it is that label's smoothed share.
    """
    n, width = x.shape
    share = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(share / (1 - share)))
    nodes: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "value": []}
    roots: list[int] = []

    def node(value: float) -> int:
        i = len(nodes["value"])
        for name, v in (("feature", 0), ("cut", 0.0), ("left", i), ("right", i), ("value", value)):
            nodes[name].append(v)
        return i

    if n and 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)], axis=1)
        offset = np.arange(width) * BINS
        margin = np.full(n, base)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-margin))
            g, h = p - y, p * (1 - p)
            roots.append(node(0.0))
            live = {roots[-1]: np.arange(n)}
            for _ in range(LEVELS):
                following = {}
                for at, rows in live.items():
                    found = _split(binned[rows], g[rows], h[rows], width, offset)
                    if found is None:
                        continue
                    feature, bin_ = found
                    if bin_ >= len(cuts[feature]):
                        continue
                    goes_left = binned[rows, feature] <= bin_
                    a, b = rows[goes_left], rows[~goes_left]
                    nodes["feature"][at], nodes["cut"][at] = feature, float(cuts[feature][bin_])
                    for side, own in (("left", a), ("right", b)):
                        child = node(float(-RATE * g[own].sum() / (h[own].sum() + WEIGHT)))
                        nodes[side][at] = child
                        following[child] = own
                    nodes["value"][at] = 0.0
                for child, own in following.items():
                    live[child] = own
                live = following
                if not live:
                    break
            margin += _walk(x, roots[-1], nodes)
    flat = {name: np.array(v, dtype=float if name in ("cut", "value") else np.int32) for name, v in nodes.items()}
    return Trees(roots=np.array(roots, dtype=np.int32), base=base, **flat)


def _split(binned, g, h, width, offset):
    """Feature and bin with the best gain, or None."""
    flat = (binned + offset).ravel()
    size = width * BINS
    gs = np.bincount(flat, np.repeat(g, width), size).reshape(width, BINS).cumsum(axis=1)
    hs = np.bincount(flat, np.repeat(h, width), size).reshape(width, BINS).cumsum(axis=1)
    ns = np.bincount(flat, minlength=size).reshape(width, BINS).cumsum(axis=1)
    total_g, total_h, n = g.sum(), h.sum(), len(g)
    gain = gs**2 / (hs + WEIGHT) + (total_g - gs) ** 2 / (total_h - hs + WEIGHT) - total_g**2 / (total_h + WEIGHT)
    gain[(ns < LEAST) | (n - ns < LEAST)] = 0
    best = int(gain.argmax())
    return divmod(best, BINS) if gain.flat[best] > 1e-6 else None


def _walk(x, root, nodes):
    feature, cut, left, right, value = (np.array(nodes[k][root:]) for k in ("feature", "cut", "left", "right", "value"))
    at = np.zeros(len(x), dtype=np.int64)
    for _ in range(LEVELS):
        at = np.where(x[np.arange(len(x)), feature[at]] <= cut[at], left[at] - root, right[at] - root)
    return value[at]


def held_out(key: Column) -> Column:
    """Whether a row never trains: crc32 of its id as text is divisible by 5. False for a null id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    rows: int = TRAIN_ROWS,
) -> Trees:
    """Trees from the statistics of at most ``rows`` labelled documents that are not held out.

    They are taken by a hash of their id, so the same tables give the same trees. A repeated label row
    counts once; where copies differ the majority holds, and a tie is 1. Null labels are ignored. Of the
    texts that share an id one trains, the one with the smallest hash. Very long texts are read whole.
    """
    usable = (
        labels.select(F.col(key).alias("k"), F.col(label).alias("l"))
        .where(F.col("k").isNotNull() & F.col("l").isNotNull() & ~held_out(F.col("k")))
        .groupBy("k")
        .agg((F.avg("l") >= 0.5).cast("int").alias("l"))
    )
    # A share of the ids by their hash leaves few more than ``rows`` to choose from.
    share = min(1.0, 1.2 * rows / max(usable.count(), 1))
    near = F.pmod(F.xxhash64("k"), F.lit(_SCALE)) <= int(share * _SCALE)
    chosen = usable.where(near).orderBy(F.xxhash64("k"), "k").limit(rows)
    # The chosen ids are at most ``rows``, so they can go to every task. An id may stand with many texts.
    own = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k")
    one = own.groupBy("k").agg(F.min_by("t", F.xxhash64("t")).alias("t"), F.first("l").alias("l"))
    sample = statistics(one, "t").select("k", "statistics", "l").toPandas()
    if len(sample) > rows:
        raise AssertionError("more rows to train on than ids chosen")
    x = np.stack(sample["statistics"].to_list()) if len(sample) else np.zeros((0, len(STATISTICS)))
    order = np.lexsort((*x.T, sample["k"].to_numpy()))
    return fit(x[order], sample["l"].to_numpy(dtype=float)[order])


def score(df: DataFrame, trees: Trees, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with ``out``, the chance that a text has label 1, for every whole text.

    A null text counts as empty and has a score like any other; repeated rows stay and have equal
    scores. Other columns pass through; one already named ``out`` is replaced. No rows give no rows.
    """

    def start() -> Callable:
        def compute(texts: pa.Array) -> pa.Array:
            scores = [np.zeros(0)]
            for at in range(0, len(texts), 512):
                rows = [text_statistics(x.as_py() or "") for x in texts[at : at + 512]]
                scores.append(trees.score(np.stack(rows)))
            return pa.array(np.concatenate(scores))

        return compute

    return with_computed(df, text, out, "double", start)
