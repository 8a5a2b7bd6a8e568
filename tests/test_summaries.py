"""Clustering features, Ward's hierarchy and the Euclidean silhouette against plain forms."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tickloom.operators.summaries import FeatureTree, cluster_features, euclidean_silhouette, ward, ward_cluster


def frame(spark, x, labels=None, parts=5):
    labels = labels if labels is not None else [0] * len(x)
    rows = [(i, Vectors.dense(v), None if c is None else int(c)) for i, (v, c) in enumerate(zip(x.tolist(), labels, strict=True))]
    if not rows:
        return spark.createDataFrame([(0, Vectors.dense([0.0]), 0)], ["id", "features", "label"]).limit(0)
    return spark.createDataFrame(rows, ["id", "features", "label"]).repartition(parts)


def blobs(seed=1, n=200, dims=3):
    rng = np.random.default_rng(seed)
    return np.concatenate([rng.normal(c, 0.3, size=(n // 5, dims)) for c in range(0, 20, 4)])


def plain_ward(n, mean):
    """One merge after another, always the cheapest pair."""
    groups = [([i], float(w), m.astype(float)) for i, (w, m) in enumerate(zip(n, mean, strict=True))]
    heights, history = [], []
    while len(groups) > 1:
        best = min((a[1] * b[1] / (a[1] + b[1]) * ((a[2] - b[2]) ** 2).sum(), i, j)
                   for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
        heights.append(best[0])
        a, b = groups[best[1]], groups[best[2]]
        both = (a[0] + b[0], a[1] + b[1], (a[1] * a[2] + b[1] * b[2]) / (a[1] + b[1]))
        groups = [g for k, g in enumerate(groups) if k not in best[1:]] + [both]
        history.append({frozenset(g[0]) for g in groups})
    return heights, history


def test_ward_equals_one_merge_after_another():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 10, 40):
        n, mean = rng.integers(1, 9, size), rng.normal(size=(size, 2))
        found = ward(n, mean)
        heights, history = plain_ward(n, mean)
        assert np.allclose([m[2] for m in found.merges], heights)
        for k in range(1, size):
            labels = found.cut(k)
            assert {frozenset(np.flatnonzero(labels == c).tolist()) for c in set(labels.tolist())} == history[size - k - 1]


def test_equal_points_end():
    assert len(ward(np.ones(6), np.zeros((6, 2))).merges) == 5
    assert len(ward(np.ones(4), np.array([[0, 0], [0, 1], [1, 0], [1, 1.0]])).merges) == 3


@pytest.mark.parametrize("threshold", [0.0, 0.2])
def test_tree_keeps_sums_and_radii(threshold):
    x = blobs(2, 1000)
    tree = FeatureTree(3, threshold, limit=60)
    for v in x:
        tree.add(1.0, v, 0.0)
    n, mean, m2 = (np.array(c) for c in zip(*tree.leaves(), strict=True))
    assert len(n) == tree.entries <= 60 and n.sum() == 1000
    assert np.allclose(n @ mean, x.sum(axis=0))
    assert np.sqrt(m2 / n).max() <= tree.threshold * (1 + 1e-9)
    total = ((x - x.mean(axis=0)) ** 2).sum()
    assert np.isclose(m2.sum() + n @ ((mean - x.mean(axis=0)) ** 2).sum(axis=1), total)


def test_trees_of_partitions_are_merged(spark):
    x = blobs(3, 300)
    rows = cluster_features(frame(spark, x, parts=20), threshold=0.1, limit=50).collect()
    assert len(rows) <= 50 and sum(r["n"] for r in rows) == 300 and len({r["threshold"] for r in rows}) == 1
    assert np.allclose(sum(r["n"] * np.array(r["mean"]) for r in rows), x.sum(axis=0))
    assert all(np.sqrt(r["m2"] / r["n"]) <= r["threshold"] * (1 + 1e-9) for r in rows)


def test_ward_cluster_labels_every_row(spark):
    x = blobs(4, 200)
    exact = {r["id"]: r["cluster"] for r in ward_cluster(frame(spark, x), 5, limit=500).collect()}
    few = {r["id"]: r["cluster"] for r in ward_cluster(frame(spark, x), 5, limit=40).collect()}
    want = ward(np.ones(200), x).cut(5)
    for got in (exact, few):
        assert len({(got[i], want[i]) for i in range(200)}) == 5
    assert len({r["cluster"] for r in ward_cluster(frame(spark, x[:3]), 5).collect()}) == 3
    assert ward_cluster(frame(spark, x[:0]), 5).collect() == []


def plain_silhouette(x, labels):
    gaps, scores = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), []
    for i, c in enumerate(labels):
        own = np.flatnonzero([v == c for v in labels])
        if len(own) == 1:
            scores.append(0.0)
            continue
        a = gaps[i, own].sum() / (len(own) - 1)
        b = min(gaps[i, [v == o for v in labels]].mean() for o in set(labels) - {c})
        scores.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(scores))


def test_silhouette(spark):
    x = blobs(6, 200)
    x[10:14] = x[9]  # copies
    labels = [i % 3 if i % 4 else None if i % 8 else 7 for i in range(199)] + [99]
    want = plain_silhouette(x, labels)
    exact = euclidean_silhouette(frame(spark, x, labels), cluster="label", limit=500).first()
    assert np.allclose([exact["silhouette"], exact["lower"], exact["upper"]], want)
    near = euclidean_silhouette(frame(spark, x, labels), cluster="label", limit=60).first()
    assert near["lower"] <= want <= near["upper"] and near["upper"] - near["lower"] < 0.2
    assert euclidean_silhouette(frame(spark, x), cluster="label").first()["silhouette"] is None
    assert euclidean_silhouette(frame(spark, x[:0]), cluster="label").first()["silhouette"] is None
