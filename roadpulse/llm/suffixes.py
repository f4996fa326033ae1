"""Suffix arrays by the difference cover of 3, and long strings that repeat in other documents."""

from __future__ import annotations

import numpy as np

_ROOM = 1 << 62


def _paired(first: np.ndarray, second: np.ndarray, size: int, more: int) -> tuple[np.ndarray, int]:
    """One number per row that orders rows as (first, second) do, and a bound of it.

    Values of ``first`` are below ``size``, those of ``second`` below ``more``.
    """
    if size * more >= _ROOM:  # too wide for 64 bits: number the distinct values first
        distinct, first = np.unique(first, return_inverse=True)
        size = len(distinct)
    return first * np.int64(more) + second, size * more


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of a row of positive numbers, in order.

    Suffixes that start at places not divisible by 3 are the sample: their triples are sorted and named,
    and while names repeat, the row of names is sorted in the same way. The others are then ordered by
    their first number and the rank of what follows, and merged with the sample.
    """
    n = len(s)
    if n < 8:
        row = s.tolist()
        return np.array(sorted(range(n), key=lambda i: row[i:]), dtype=np.int64)
    size = int(s.max()) + 1
    s = np.concatenate((s.astype(np.int64, copy=False), np.zeros(4, dtype=np.int64)))
    pairs, wide = _paired(s[:-1], s[1:], size, size)
    # With n = 3k + 1 the empty suffix at n joins the sample, so that every other place has its successor in it.
    firsts, seconds = (n + (n % 3 == 1) + 1) // 3, n // 3
    triples, _ = _paired(pairs[:-1], s[2:], wide, size)
    triples = np.concatenate((triples[1::3][:firsts], triples[2::3][:seconds]))
    order = np.argsort(triples)
    ordered_triples = triples[order]
    new = np.concatenate(([True], ordered_triples[1:] != ordered_triples[:-1]))
    if not new.all():
        names = np.empty(len(order), dtype=np.int64)
        names[order] = np.cumsum(new)
        order = suffix_array(names)
    is_first = order < firsts
    ordered = np.where(is_first, 3 * order + 1, 3 * (order - firsts) + 2)
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[ordered] = np.arange(1, len(ordered) + 1)
    ranks = len(ordered) + 1

    # The others: by their first number and the rank of the sample suffix that follows.
    count = (n + 2) // 3
    key, _ = _paired(s[:n:3], rank[1 : n + 2 : 3][:count], size, ranks)
    place = np.argsort(key)
    rest, key = 3 * place, key[place]
    one, two = ordered[is_first], ordered[~is_first]
    one = one[one < n]
    before = np.arange(count) + np.searchsorted(_paired(s[one], rank[one + 1], size, ranks)[0], key)
    # The other class of the sample is compared by two numbers and the rank after them.
    key, _ = _paired(pairs[: n + 1], rank[2 : n + 3], wide, ranks)
    before += np.searchsorted(key[two], key[rest])
    merged, free = np.empty(n, dtype=np.int64), np.ones(n, dtype=bool)
    merged[before] = rest
    free[before] = False
    merged[free] = ordered[ordered < n]
    return merged


def equal_prefixes(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Group numbers of ``starts``, which are in suffix order: equal where ``length`` bytes are."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    view = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded.data, strides=(1,))
    same = np.ones(max(len(starts) - 1, 0), dtype=bool)
    for at in [*range(0, length - 8, 8), length - 8]:
        word = view[starts + at]
        same &= word[1:] == word[:-1]
    return np.concatenate(([0], np.cumsum(~same))) if len(starts) else np.zeros(0, dtype=np.int64)


def repeated_windows(data: np.ndarray, lengths: np.ndarray, owners: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, start) of every window of ``length`` bytes that also stands with a smaller owner.

    ``data`` are the bytes of the texts end to end, ``lengths`` their sizes (``length`` or more), ``owners`` whose each is.
    """
    ends = np.cumsum(lengths)
    firsts = ends - lengths
    # A zero, below every byte + 1, ends each text.
    row = np.zeros(len(data) + len(lengths), dtype=np.int64)
    number = np.repeat(np.arange(len(lengths)), lengths)
    row[np.arange(len(data)) + number] = data.astype(np.int64) + 2
    row[ends + np.arange(len(lengths))] = 1
    order = suffix_array(row)
    # Back to places in ``data``; only places at which a whole window starts count.
    text = np.searchsorted(ends + np.arange(len(lengths)), order)
    place = order - text
    whole = place + length <= ends[text]
    text, place = text[whole], place[whole]
    group = equal_prefixes(data, place, length)
    if not len(group):
        return text, place
    owner = owners[text]
    heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    least = np.minimum.reduceat(owner, heads)[group]
    later = owner > least
    return text[later], place[later] - firsts[text[later]]
