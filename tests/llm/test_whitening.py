import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadpulse.llm import queries, whitening


def whole(vector):
    return [math.floor(64 * float(np.float64(c))) + 1_000_000 for c in vector]


def by_hand(vectors):
    """(n, deviations, covariance, centred rows) with whole numbers and numpy's own eigenvectors."""
    x = [whole(v) for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    return n, deviations, centred.T @ centred / n, centred


def check(rows, ids, vectors, most=32):
    n, deviations, v, centred = by_hand(vectors)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    found = {(r["vec_id"], r["component"]): r for r in rows}
    k = min(most, int((e > 1e-10 * e[0]).sum()))
    assert set(found) == {(i, c) for i in ids for c in range(1, k + 1)} and len(rows) == len(ids) * k
    for c in range(1, k + 1):
        want = centred @ u[:, c - 1] / np.sqrt(e[c - 1])
        got = np.array([found[i, c]["whitened"] for i in ids])
        if abs(e[c - 1] - e[c - 2]) > 1e-6 * e[0] or c == 1:
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        assert all(abs(found[i, c]["explained"] - e[c - 1] / np.trace(v)) < 1e-10 for i in ids)
    for i, d in zip(ids, deviations):
        assert {(found[i, c]["n"], found[i, c]["deviation"]) for c in range(1, k + 1)} == {(n, d)}
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_query_equals_brute_force(spark, small):
    given = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    rows = queries.op13_embedding_whitening(spark, small).collect()
    check(rows, [r["vec_id"] for r in given], [r["embedding"] for r in given])


def whitened(spark, folder, data, kind="array<double>"):
    frame = spark.createDataFrame(data, f"vec_id long, embedding {kind}, label int")
    frame.write.parquet(f"{folder}/embeddings.parquet")
    return queries.op13_embedding_whitening(spark, str(folder)).collect()


def test_odd_rows_are_left_out_and_copies_count(spark, tmp_path):
    rng = np.random.default_rng(3)
    good = [(i, [float(c) for c in rng.normal(size=5)], 0) for i in range(40)]
    good += [(40 + i, good[7][1], 0) for i in range(30)]
    odd = [(90, None, 0), (91, [1.0, None, 1.0, 1.0, 1.0], 0), (92, [math.nan] * 5, 0), (93, [math.inf, 0.0, 0.0, 0.0, 0.0], 0), (94, [1.0], 0), (95, [], 0)]
    rows = whitened(spark, tmp_path, good + odd)
    check(rows, [r[0] for r in good], [r[1] for r in good])


def test_directions_without_variance_are_no_components(spark, tmp_path):
    rng = np.random.default_rng(5)
    data = [(i, [float(a), 3.0, float(2 * a), float(b)], 0) for i, (a, b) in enumerate(rng.integers(-9, 9, size=(50, 2)))]
    rows = whitened(spark, tmp_path, data)
    assert {r["component"] for r in rows} == {1, 2}
    check(rows, [r[0] for r in data], [r[1] for r in data])


@pytest.mark.parametrize("vectors", [[], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [None], [[]]])
def test_nothing_to_whiten(spark, tmp_path, vectors):
    assert whitened(spark, tmp_path, [(i, v, 0) for i, v in enumerate(vectors)]) == []


def test_very_large_entries_stay_exact(spark, tmp_path):
    rng = np.random.default_rng(9)
    vectors = [[float(c) for c in row] for row in rng.normal(size=(30, 3)) * [1e9, 1.0, 1e6]]
    rows = whitened(spark, tmp_path, [(i, v, 0) for i, v in enumerate(vectors)])
    n, deviations, v, _ = by_hand(vectors)
    first = {r["vec_id"]: r for r in rows if r["component"] == 1}
    for i, d in enumerate(deviations):
        assert first[i]["deviation"] == (d if d < 2**63 else None)
    assert abs(first[0]["explained"] - np.linalg.eigvalsh(v)[-1] / np.trace(v)) < 1e-9


def test_names_that_clash(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").limit(50)
    rows = rows.withColumns({"both": F.lit(1), "Source": F.lit(2), "i": F.lit(3), "blob": F.lit(4), "deviation": F.lit(5)})
    model = whitening.fit(rows)
    made = whitening.whiten(rows, model)
    assert made.columns == ["vec_id", "embedding", "label", "both", "Source", "i", "blob", "whitened", "deviation"]
    assert {(r["both"], r["Source"], r["i"], r["blob"]) for r in made.collect()} == {(1, 2, 3, 4)}


def test_factor_and_rotations_on_hard_matrices():
    rng = np.random.default_rng(1)
    for d, r in [(1, 1), (2, 2), (7, 7), (12, 5), (40, 40)]:
        b = rng.normal(size=(d, r)) * np.logspace(0, -5, r)
        v = b @ b.T
        a = whitening.pivoted_cholesky(v)
        assert a.shape == (d, r) and np.abs(a @ a.T - v).max() < 1e-12 * max(1, np.trace(v))
        e, u = whitening.principal_components(v)
        assert np.abs(u.T @ u - np.eye(r)).max() < 1e-7 and (np.diff(e) <= 0).all()
        assert np.abs(u * e @ u.T - v).max() < 1e-12 * max(1, np.trace(v))
    assert whitening.principal_components(np.zeros((3, 3)))[1].shape == (3, 0)
