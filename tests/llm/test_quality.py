"""The quality classifier: held-out accuracy, determinism, odd texts."""

import numpy as np
import pytest

from roadpulse.llm import quality as Q
from roadpulse.llm.common import table


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return table(spark, folder, "documents"), table(spark, folder, "labels")


def test_held_out_accuracy(tables):
    docs, labels = tables
    scored = Q.score(docs, Q.train(docs, labels)).join(labels.select("doc_id", "quality"), "doc_id")
    rows = scored.where(Q.held_out(scored["doc_id"])).toPandas()
    assert ((rows["score"] >= 0.3) == (rows["quality"] == 1)).mean() >= 0.95
    good, bad = (rows["score"][rows["quality"] == q].to_numpy() for q in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() >= 0.98
    assert (good >= 0.3).all()


def test_bounded_and_repeatable(tables):
    docs, labels = tables
    first, second = (Q.train(docs, labels, rows=50) for _ in range(2))
    assert np.array_equal(first.value, second.value) and np.array_equal(first.cut, second.cut)


def test_copies_of_an_id_train_once(spark, tables, monkeypatch):
    docs, labels = tables
    key = labels.where(~Q.held_out(labels["doc_id"])).first()["doc_id"]
    copies = docs.where(docs["doc_id"] == key).crossJoin(spark.range(500)).selectExpr("doc_id", "concat(text, id % 3) AS text")
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y: seen.append(len(x)))
    one = labels.where(labels["doc_id"] == key)
    Q.train(copies, one, rows=2)
    Q.train(docs.select("doc_id", "text").unionByName(copies), labels, rows=20)
    assert seen == [1, 20]


def plain_split(x, g, h):
    """Best (gain, feature, cut) over all cuts between values, by trying each."""
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(np.quantile(x[:, f], np.linspace(0, 1, Q.BINS + 1)[1:-1])):
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < Q.LEAST:
                continue
            parts = [g[s].sum() ** 2 / (h[s].sum() + Q.WEIGHT) for s in (left, ~left)]
            gain = sum(parts) - g.sum() ** 2 / (h.sum() + Q.WEIGHT)
            if gain > best[0] + 1e-9:
                best = (gain, f, cut)
    return best


def test_first_splits_equal_a_plain_search():
    for seed in range(3):
        rng = np.random.default_rng(seed)
        x = np.round(rng.normal(size=(200, 5)), 1)
        y = (x[:, seed] + 0.3 * rng.normal(size=200) > 0.2).astype(float)
        trees = Q.fit(x, y)
        p = 1 / (1 + np.exp(-np.full(200, trees.base)))
        root = trees.roots[0]
        gain, feature, cut = plain_split(x, p - y, p * (1 - p))
        assert (trees.feature[root], trees.cut[root]) == (feature, cut)
        for side, rows in (("left", x[:, feature] <= cut), ("right", x[:, feature] > cut)):
            child = getattr(trees, side)[root]
            want = plain_split(x[rows], (p - y)[rows], (p * (1 - p))[rows])
            # A node's cuts come from all rows; a node without a gain is a leaf.
            if trees.left[child] != child:
                chosen = x[rows][:, trees.feature[child]] <= trees.cut[child]
                g, h = (p - y)[rows], (p * (1 - p))[rows]
                got = sum(g[s].sum() ** 2 / (h[s].sum() + Q.WEIGHT) for s in (chosen, ~chosen)) - g.sum() ** 2 / (h.sum() + Q.WEIGHT)
                assert got > 0 and got >= 0.9 * want[0]


def test_walk_equals_single_steps():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(Q.STATISTICS)))
    trees = Q.fit(x, (x[:, 3] + x[:, 5] > 0).astype(float))
    one = []
    for row in x:
        total = trees.base
        for node in trees.roots:
            while trees.left[node] != node:
                node = trees.left[node] if row[trees.feature[node]] <= trees.cut[node] else trees.right[node]
            total += trees.value[node]
        one.append(1 / (1 + np.exp(-total)))
    assert np.allclose(trees.score(x), one)
    assert ((trees.score(x) > 0.5) == (x[:, 3] + x[:, 5] > 0)).mean() > 0.95


def test_odd_rows_and_labels(spark, tables):
    docs, labels = tables
    trees = Q.train(docs, labels)
    odd = spark.createDataFrame(
        [(1, None, "a", 1), (1, "", "b", 2), (None, "x" * 200_000, "c", 3), (2, "a\nb\n\x00", "d", 4), (2, "a\nb\n\x00", "d", 4)],
        "doc_id long, text string, score string, statistics int",
    )
    rows = Q.score(odd, trees).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert rows[0]["score"] == rows[1]["score"] and rows[3]["score"] == rows[4]["score"]
    assert Q.score(odd.limit(0), trees).collect() == []
    none = Q.train(docs, labels.limit(0))
    assert Q.score(odd, none).first()["score"] == 0.5
    nulls = labels.selectExpr("doc_id", "cast(null as int) as quality").unionByName(
        labels.selectExpr("cast(null as long) as doc_id", "quality")
    )
    assert Q.score(odd, Q.train(docs, nulls)).first()["score"] == 0.5
    same = Q.train(docs, labels.unionByName(labels))
    assert np.array_equal(same.value, trees.value)
