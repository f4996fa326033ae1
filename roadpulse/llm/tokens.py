"""Edit-aware token counts: a tree of pre-token segments per document.

A leaf stands for some neighbouring pre-tokens and holds their characters and tokens; inner nodes hold
sums. An edit re-encodes from the last leaf border that the changed characters cannot have influenced to
the first border at which the new pre-tokens meet the old ones again, and updates the sums above.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, in_parts

LEAF = 64  # pre-tokens of a leaf when it is built
MOST_PIECES = 500_000  # remembered pre-tokens of a task; beyond it the memory starts anew
#: A pre-token is decided by characters up to this many places after its end.
_AHEAD = 2


class Counter:
    """Counts tokens of pre-tokens with the ranks of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern, self.known = regex.compile(pattern), {}

    def pieces(self, found: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        known = self.known
        if len(known) > MOST_PIECES:
            known.clear()
        try:
            return [known[x] for x in found]
        except KeyError:
            for x in set(found).difference(known):
                known[x] = len(self.encoding._encode_single_piece(x))
            return [known[x] for x in found]


class Tree:
    """Sums over leaves in a complete binary tree: node i has children 2i and 2i + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves = max(len(chars), 1)
        self.half = 1 << (self.leaves - 1).bit_length()
        self.sums = np.zeros((2, 2 * self.half), dtype=np.int64)
        self.sums[0, self.half : self.half + len(chars)] = chars
        self.sums[1, self.half : self.half + len(tokens)] = tokens
        level = self.half
        while level > 1:
            self.sums[:, level // 2 : level] = self.sums[:, level : 2 * level : 2] + self.sums[:, level + 1 : 2 * level : 2]
            level //= 2

    @property
    def chars(self) -> int:
        return int(self.sums[0, 1])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds a place of the text, and where the leaf starts; the last leaf for the end."""
        node, start = 1, 0
        while node < self.half:
            left = int(self.sums[0, 2 * node])
            node *= 2
            if place >= start + left:
                start += left
                node += 1
        if node - self.half >= self.leaves or not self.sums[0, node]:
            # Beyond the text: back to the last leaf with characters.
            own = np.flatnonzero(self.sums[0, self.half : node + 1])
            last = int(own[-1]) if len(own) else 0
            return last, start - int(self.sums[0, self.half + last])
        return node - self.half, start

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        """Change a leaf and the sums above it."""
        node = self.half + leaf
        change = np.array([chars, tokens]) - self.sums[:, node]
        while node:
            self.sums[:, node] += change
            node //= 2

    def leaf(self, i: int) -> tuple[int, int]:
        return int(self.sums[0, self.half + i]), int(self.sums[1, self.half + i])

    def arrays(self) -> np.ndarray:
        """Characters and tokens of the leaves, as two rows."""
        return self.sums[:, self.half : self.half + self.leaves]


def build(text: str, counter: Counter) -> Tree:
    """The tree of a whole text."""
    found = counter.pattern.findall(text)
    if not found:
        return Tree(np.zeros(0, np.int64), np.zeros(0, np.int64))
    at = np.arange(0, len(found), LEAF)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    return Tree(np.add.reduceat(sizes, at), np.add.reduceat(np.array(counter.pieces(found)), at))


def edit(text: str, tree: Tree, start: int, removed: int, inserted: str, counter: Counter) -> tuple[str, int]:
    """The edited text and how many characters were encoded anew; the tree is updated in place.

    A start or an end outside the text is moved to its border.
    """
    start = min(max(start, 0), len(text))
    stop = min(start + max(removed, 0), len(text))
    new = text[:start] + inserted + text[stop:]
    shift = len(new) - len(text)
    first, border = tree.find(max(start - _AHEAD, 0))
    # The first leaf is always written anew; ``old_end`` is the end of the leaves given up so far.
    leaf, old_end = first + 1, border + tree.leaf(first)[0]
    at, found = border, []
    for match in counter.pattern.finditer(new, border):
        while leaf < tree.leaves and (old_end < stop or old_end + shift < at):
            old_end += tree.leaf(leaf)[0]
            leaf += 1
        if at >= start + len(inserted) and old_end >= stop and old_end + shift == at:
            break
        found.append(match[0])
        at = match.end()
    else:
        leaf = tree.leaves
    tree.set(first, at - border, sum(counter.pieces(found)))
    for i in range(first + 1, leaf):
        tree.set(i, 0, 0)
    return new, at - border


_TREE = "struct<n_tokens:bigint,leaf_chars:array<int>,leaf_tokens:array<int>>"


def _sent(df: DataFrame, path: str):
    """The vocabulary's ranks for the executors; their size is that of the file, about a MB."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return df.sparkSession.sparkContext.broadcast(ranks)


def _tree_column(trees: list[Tree]) -> pa.StructArray:
    parts = [t.arrays().astype(np.int32) for t in trees]
    ends = pa.array(np.cumsum([0, *(p.shape[1] for p in parts)]), pa.int32())
    flat = np.concatenate(parts, axis=1) if parts else np.zeros((2, 0), np.int32)
    lists = [pa.ListArray.from_arrays(ends, pa.array(row)) for row in flat]
    total = pa.array([t.tokens for t in trees], pa.int64())
    return pa.StructArray.from_arrays([total, *lists], ["n_tokens", "leaf_chars", "leaf_tokens"])


def _mapped(df: DataFrame, drop: list[str], inputs: list[str], made: dict[str, str], run: Callable) -> DataFrame:
    """The rows without ``drop``, with the columns ``made`` that ``run()`` computes from ``inputs``."""
    kept = [c for c in df.columns if c not in (*drop, *made)]
    width = len(kept)

    def batches(given):
        compute = run()
        for batch in in_parts(given):
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], *compute(*batch.columns[width:])], names=[*kept, *made]
            )

    own = [F.col(f"`{c}`") for c in kept]
    schema = df.select(*own, *[F.lit(None).cast(t).alias(c) for c, t in made.items()]).schema
    given = [F.col(f"`{c}`").alias(free_name(df, f"in_{i}")) for i, c in enumerate(inputs)]
    return df.select(*own, *given).mapInArrow(batches, schema)


def with_tree(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "tree") -> DataFrame:
    """The rows with ``out``: n_tokens of the whole text, and characters and tokens of each leaf.

    A null or empty text has no tokens and one empty leaf. Repeated rows stay; other columns pass through
    and one already named ``out`` is replaced. ``path`` is a file of ranks, ``pattern`` splits pre-tokens.
    """
    ranks = _sent(df, path)

    def run() -> Callable:
        counter = Counter(ranks.value, pattern)
        return lambda texts: [_tree_column([build(x.as_py() or "", counter) for x in texts])]

    return _mapped(df, [], [text], {out: _TREE}, run)


def with_edits(
    df: DataFrame, path: str, pattern: str, text: str = "text", tree: str = "tree", edits: str = "edits"
) -> DataFrame:
    """The rows after their edits: ``text``, ``tree`` and ``reencoded_chars``; ``edits`` are used up.

    ``edits`` is an array of (start, removed, inserted), applied in order, each to the text that the one
    before left; places count code points. Null edits change nothing, a null inserted text is empty, a
    null number is 0 and a place outside the text is moved to its border. ``tree`` is that of ``with_tree``.
    """
    ranks = _sent(df, path)

    def run() -> Callable:
        counter = Counter(ranks.value, pattern)

        def compute(texts, trees, lists):
            out, updated, work = [], [], []
            chars, tokens = trees.field("leaf_chars"), trees.field("leaf_tokens")
            for i in range(len(texts)):
                own = texts[i].as_py() or ""
                kept = Tree(*(np.asarray(x[i].values, dtype=np.int64) for x in (chars, tokens)))
                done = 0
                for step in lists[i].as_py() or []:
                    own, n = edit(own, kept, step["start"] or 0, step["removed"] or 0, step["inserted"] or "", counter)
                    done += n
                out.append(own)
                updated.append(kept)
                work.append(done)
            return [pa.array(out, pa.string()), _tree_column(updated), pa.array(work, pa.int64())]

        return compute

    return _mapped(df, [edits], [text, tree, edits], {text: "string", tree: _TREE, "reencoded_chars": "bigint"}, run)
