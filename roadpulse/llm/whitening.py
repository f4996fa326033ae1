"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on its factor.

Entries become whole numbers, so sums and products over all rows are exact and do not depend on how rows
are dealt out. Tasks centre their rows by whole numbers near the means before they multiply, and what the
means differ from those is taken off exactly at the end. Each task hands on one small square of sums;
these are added in two rounds. Only that square, its size given by the dimension, comes to the driver:
there it is factored as ``L L'`` with the largest remaining diagonal first, and rotations of the columns of
``L`` make them orthogonal. Their squared norms are the eigenvalues, the columns themselves the components.

Rows whose vector is null, or holds a null, NaN or infinite entry, are left out. All others count, copies
and repeated rows included. Where lengths differ, rows of the most frequent length count (ties: the longer).
Entries beyond 2^60 in steps of 1/64 are taken as that. Directions without variance are no components, so
equal rows, a single row, empty vectors and an empty table give none. Any basis may stand for equal eigenvalues.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import free_name, in_parts, with_computed

STEPS, SHIFT = 64, 1_000_000  # an entry c becomes floor(STEPS * c) + SHIFT
COMPONENTS = 32
LARGEST = 2.0**60
EXACT = 2.0**53  # whole numbers below this are exact as doubles
SALTS = 16  # first round of adding: so many groups for each row of the square
PART_ROWS = 4_096
_LOW = (1 << 32) - 1


@dataclass(frozen=True)
class Whitening:
    """What was fitted: rows, whole-number centre, and components as columns by falling eigenvalue."""

    n: int
    centre: np.ndarray  # whole numbers near the means
    rest: list[int]  # sum over the rows of x - centre
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        """Share of the whole variance by component."""
        return [float(e / self.trace) for e in self.eigenvalues]


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has finite entries only and the most frequent length."""
    held = F.col(f"`{vector}`")
    finite = F.forall(held, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)))
    rows = df.where(held.isNotNull() & finite)
    lengths = rows.groupBy(F.size(held).alias("d")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size(held) == (first["d"] if first else 0))


def whole_numbers(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of whole numbers."""
    if not len(vectors):
        return np.zeros((0, 0), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        steps = np.clip(np.floor(STEPS * flat), -LARGEST, LARGEST)
    return steps.astype(np.int64).reshape(len(vectors), -1) + SHIFT


def _largest(values: np.ndarray) -> float:
    return float(np.abs(values).max(initial=0))


def _square(rows: np.ndarray) -> np.ndarray:
    """Exact sum over rows of the products of each two entries."""
    if _largest(rows) ** 2 * max(len(rows), 1) < EXACT:
        return (rows.T.astype(np.float64) @ rows.astype(np.float64)).astype(np.int64)
    wide = rows.astype(object)
    return wide.T @ wide


def _limbs(values: np.ndarray) -> np.ndarray:
    """Whole numbers as pairs (high, low) of 64-bit numbers that can be added."""
    return np.stack([(values >> 32).astype(np.int64), (values & _LOW).astype(np.int64)])


def _carried(limbs: np.ndarray) -> np.ndarray:
    return np.stack([limbs[0] + (limbs[1] >> 32), limbs[1] & _LOW])


def _joined(limbs: np.ndarray) -> list[int]:
    return [(int(high) << 32) + int(low) for high, low in zip(*limbs)]


def _summed(df: DataFrame, vector: str, start: Callable, kind: type) -> list[np.ndarray]:
    """Rows of a square of sums over all rows of ``df``, in order; ``start()`` gives a task's function on a batch."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute, total = start(), None
        for batch in in_parts(batches, PART_ROWS):
            made = compute(batch.column(0))
            total = made if total is None else total + made
            total = _carried(total) if kind is np.int64 else total
        if total is not None:
            rows = np.moveaxis(total, -2, 0)
            salt = zlib.crc32(total.tobytes()) % SALTS
            columns = [pa.array(range(len(rows)), pa.int32()), pa.array([salt] * len(rows), pa.int32())]
            blobs = pa.array([np.ascontiguousarray(r).tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, blobs], names=["i", "salt", "blob"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, first = 0, None
        for batch in batches:
            first = batch.slice(0, 1) if first is None else first
            for blob in batch.column(2):
                total = total + np.frombuffer(blob.as_py(), kind).reshape(2 if kind is np.int64 else 1, -1)
                total = _carried(total) if kind is np.int64 else total
        made = pa.array([total.tobytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([first.column(0), first.column(1), made], names=["i", "salt", "blob"])

    schema = "i int, salt int, blob binary"
    parts = df.select(F.col(f"`{vector}`")).mapInArrow(part, schema)
    once = parts.groupBy("i", "salt").applyInArrow(added, schema)
    rows = once.groupBy("i").applyInArrow(added, schema).collect()
    return [np.frombuffer(r["blob"], kind).reshape(2 if kind is np.int64 else 1, -1) for r in sorted(rows, key=lambda r: r["i"])]


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """``A`` with ``A A' = v``: rows in the given order, a column per independent direction."""
    a, d = v.astype(np.float64).copy(), len(v)
    order, factor = np.arange(d), np.zeros((d, d))
    least = d * np.finfo(np.float64).eps * a.diagonal().max(initial=0.0)
    rank = 0
    while rank < d:
        k = rank
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > least:
            break
        for swapped in (a, a.T, factor):
            swapped[[k, p]] = swapped[[p, k]]
        order[[k, p]] = order[[p, k]]
        factor[k, k] = np.sqrt(a[k, k])
        factor[k + 1 :, k] = a[k + 1 :, k] / factor[k, k]
        a[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
        rank += 1
    out = np.zeros((d, rank))
    out[order] = factor[:, :rank]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Columns of ``factor`` rotated until each two are orthogonal to working precision.

    Pairs meet as in a tournament, so the disjoint pairs of a round are rotated side by side.
    """
    a = factor.copy()
    r = a.shape[1]
    if r < 2:
        return a
    seats = [*range(r), *([None] if r % 2 else [])]
    eps = np.finfo(np.float64).eps
    for _ in range(sweeps):
        turned = False
        for _ in range(len(seats) - 1):
            pairs = [(x, y) for x, y in zip(seats, reversed(seats[len(seats) // 2 :])) if x is not None and y is not None]
            p, q = (np.array(side) for side in zip(*pairs))
            seats = [seats[0], seats[-1], *seats[1:-1]]
            ap, aq = a[:, p], a[:, q]
            alpha, beta, gamma = (ap * ap).sum(0), (aq * aq).sum(0), (ap * aq).sum(0)
            due = np.abs(gamma) > eps * np.sqrt(alpha * beta)
            if not due.any():
                continue
            turned = True
            safe = np.where(due, gamma, 1.0)
            zeta = (beta - alpha) / (2.0 * safe)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = np.where(due, 1.0 / np.hypot(1.0, t), 1.0)
            s = np.where(due, c * t, 0.0)
            a[:, p], a[:, q] = c * ap - s * aq, s * ap + c * aq
        if not turned:
            break
    return a


def principal_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, components as columns) of a covariance, by falling eigenvalue.

    The largest entry of a component is positive.
    """
    a = one_sided_jacobi(pivoted_cholesky(v))
    norms = np.sqrt((a * a).sum(0))
    order = np.argsort(-norms, kind="stable")
    unit = a[:, order] / norms[order]
    signs = np.sign(unit[np.abs(unit).argmax(0), np.arange(unit.shape[1])]) if unit.size else 1.0
    return norms[order] ** 2, unit * signs


def _centred(x: np.ndarray, model: Whitening) -> np.ndarray:
    """``n * (x - mean)``, exactly."""
    z = x - model.centre
    if _largest(z) * model.n + max(map(abs, model.rest), default=0) >= 2.0**62:
        z = z.astype(object)
        return z * model.n - np.array(model.rest, dtype=object)
    return z * model.n - np.array(model.rest, dtype=np.int64)


def _whitened(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """(n * (x - mean), whitened rows)."""
    deviations = _centred(x, model)
    return deviations, (deviations / model.n).astype(np.float64) @ (model.components / np.sqrt(model.eigenvalues))


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Means, components and eigenvalues of all rows of ``usable(df)``; None where no direction has variance."""

    def totals() -> Callable:
        def compute(vectors: pa.Array) -> np.ndarray:
            x = whole_numbers(vectors)
            wide = x.astype(object) if _largest(x) * len(x) >= 2.0**62 else x
            return _limbs(np.concatenate([wide.sum(axis=0), [len(x)]]))[:, None, :]

        return compute

    summed = _summed(df, vector, totals, np.int64)
    if not summed:
        return None
    *sums, n = _joined(summed[0])
    if not sums:
        return None
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, centre)]

    def products() -> Callable:
        return lambda vectors: _limbs(_square(whole_numbers(vectors) - centre))

    square = [_joined(row) for row in _summed(df, vector, products, np.int64)]
    # Every quotient of whole numbers is the double nearest to it.
    v = np.array([[(n * p - a * b) / (n * n) for p, b in zip(row, rest)] for row, a in zip(square, rest)])
    eigenvalues, unit = principal_components(v)
    kept = min(components, len(eigenvalues))
    if not kept:
        return None
    model = Whitening(n, centre, rest, eigenvalues[:kept], unit[:, :kept], float(np.trace(v)), 0.0)

    def spread() -> Callable:
        def compute(vectors: pa.Array) -> np.ndarray:
            _, w = _whitened(whole_numbers(vectors), model)
            beside = np.vstack([w.T @ w, w.sum(axis=0)])
            return beside[None]

        return compute

    *rows, means = [r[0] / n for r in _summed(df, vector, spread, np.float64)]
    covariance = np.array(rows) - np.outer(means, means)
    error = float(np.abs(covariance - np.eye(kept)).max())
    return Whitening(n, centre, rest, model.eigenvalues, model.components, model.trace, error)


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding", out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The rows with ``out`` (array<double>, an entry per component) and ``deviation`` (sum of (n * x - S)^2).

    ``df`` is ``usable`` and the model's length. A deviation beyond 64 bits is null. Other columns pass
    through, whatever their names; the two named are replaced.
    """

    def start() -> Callable:
        def compute(vectors: pa.Array) -> pa.Array:
            x = whole_numbers(vectors)
            if not len(x):
                return pa.array([], pa.struct([("w", pa.list_(pa.float64())), ("d", pa.int64())]))
            deviations, w = _whitened(x, model)
            if _largest(deviations) ** 2 * deviations.shape[1] >= 2.0**62:
                squares = [sum(int(y) ** 2 for y in row) for row in deviations]
                squares = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
            else:
                squares = pa.array((deviations * deviations).sum(axis=1), pa.int64())
            ends = np.arange(len(x) + 1, dtype=np.int32) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))
            return pa.StructArray.from_arrays([lists, squares], ["w", "d"])

        return compute

    both = free_name(df, "both")
    made = with_computed(df, vector, both, "struct<w:array<double>,d:bigint>", start)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (out, deviation)]
    return made.select(*kept, F.col(f"`{both}`.w").alias(out), F.col(f"`{both}`.d").alias(deviation))


def by_component(model: Whitening, whitened: Column) -> Column:
    """A row's whitened entries as an array of (component, whitened, explained), to be made rows of."""
    explained = F.array(*[F.lit(e) for e in model.explained])
    return F.transform(
        whitened,
        lambda w, i: F.struct((i + 1).alias("component"), w.alias("whitened"), F.get(explained, i).alias("explained")),
    )
