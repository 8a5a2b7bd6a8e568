"""Clustering features: mergeable summaries of near vectors, Ward clusters of them, and silhouettes bounded by them.

A summary is (n, mean, m2): the number of vectors, their mean and their squared distances from it. Two of them merge
exactly, so a tree built in each partition is merged in a tree of tasks, and no task or driver holds more than
a bounded number of summaries.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans.scratch import forget, stored

#: Summaries of a node of the tree; trees merged in one task; summaries a tree keeps; groups a silhouette is bounded by.
BRANCHING, FAN_IN, LIMIT, MOST_GROUPS = 32, 8, 1000, 100_000
SUMMARY = "n bigint, mean array<double>, m2 double, threshold double"


def merged_m2(n, mean, m2, n2, mean2, m22):
    """Squared distances from the common mean of two summaries; the first may be many."""
    gap = ((mean - mean2) ** 2).sum(axis=-1)
    return m2 + m22 + n * n2 / (n + n2) * gap


class Node:
    """Up to BRANCHING summaries, of the children or, in a leaf, of vectors."""

    def __init__(self, dims: int, leaf: bool) -> None:
        self.size, self.children = 0, None if leaf else []
        self.n, self.m2 = np.zeros(BRANCHING + 1), np.zeros(BRANCHING + 1)
        self.mean = np.zeros((BRANCHING + 1, dims))

    def append(self, n: float, mean: np.ndarray, m2: float, child: Node | None = None) -> None:
        self.n[self.size], self.mean[self.size], self.m2[self.size] = n, mean, m2
        self.size += 1
        if child is not None:
            self.children.append(child)

    def nearest(self, mean: np.ndarray) -> int:
        return int(((self.mean[: self.size] - mean) ** 2).sum(axis=1).argmin())

    def merge(self, i: int, n: float, mean: np.ndarray, m2: float) -> None:
        self.m2[i] = merged_m2(self.n[i], self.mean[i], self.m2[i], n, mean, m2)
        self.mean[i] += (mean - self.mean[i]) * (n / (self.n[i] + n))
        self.n[i] += n

    def total(self) -> tuple[float, np.ndarray, float]:
        n, mean = self.n[: self.size], self.mean[: self.size]
        middle = n @ mean / n.sum()
        return n.sum(), middle, float(self.m2[: self.size].sum() + n @ ((mean - middle) ** 2).sum(axis=1))

    def split(self) -> tuple[Node, Node]:
        """Two nodes, each entry beside the nearer of the two that lie furthest apart."""
        mean = self.mean[: self.size]
        gaps = ((mean[:, None] - mean[None]) ** 2).sum(axis=2)
        a, b = np.unravel_index(gaps.argmax(), gaps.shape)
        left = gaps[a] <= gaps[b]
        left[a], left[b] = True, False
        halves = Node(mean.shape[1], self.children is None), Node(mean.shape[1], self.children is None)
        for i in range(self.size):
            child = None if self.children is None else self.children[i]
            halves[0 if left[i] else 1].append(self.n[i], self.mean[i], self.m2[i], child)
        return halves


class FeatureTree:
    """A tree of summaries whose leaves have a radius of at most ``threshold``; that grows when they are more than ``limit``."""

    def __init__(self, dims: int, threshold: float, limit: int = LIMIT) -> None:
        self.dims, self.threshold, self.limit = dims, threshold, limit
        self.root, self.entries = Node(dims, True), 0

    def add(self, n: float, mean: np.ndarray, m2: float) -> None:
        halves = self._add(self.root, n, mean, m2)
        if halves:
            self.root = Node(self.dims, False)
            for half in halves:
                self.root.append(*half.total(), half)
        if self.entries > self.limit:
            self._grow()

    def _add(self, node: Node, n: float, mean: np.ndarray, m2: float) -> tuple[Node, Node] | None:
        i = node.nearest(mean) if node.size else -1
        if node.children is None:
            # rounding must not keep equal vectors apart
            room = (n + node.n[i]) * self.threshold**2 + 1e-18 * (mean @ mean) if node.size else -1.0
            if node.size and merged_m2(node.n[i], node.mean[i], node.m2[i], n, mean, m2) <= room:
                node.merge(i, n, mean, m2)
            else:
                node.append(n, mean, m2)
                self.entries += 1
        else:
            halves = self._add(node.children[i], n, mean, m2)
            if halves is None:
                node.merge(i, n, mean, m2)
            else:
                node.n[i], node.mean[i], node.m2[i] = halves[0].total()
                node.children[i] = halves[0]
                node.append(*halves[1].total(), halves[1])
        return node.split() if node.size > BRANCHING else None

    def leaves(self) -> Iterator[tuple[float, np.ndarray, float]]:
        todo = [self.root]
        while todo:
            node = todo.pop()
            if node.children is None:
                yield from zip(node.n[: node.size].tolist(), node.mean[: node.size].copy(), node.m2[: node.size].tolist(), strict=True)
            else:
                todo += node.children

    def _grow(self) -> None:
        """Begin anew with a threshold that half of the leaves could merge under with their nearest neighbour."""
        held = list(self.leaves())
        n, mean, m2 = (np.array(x) for x in zip(*held, strict=True))
        radii = np.empty(len(held))
        for i in range(len(held)):
            both = merged_m2(n, mean, m2, n[i], mean[i], m2[i]) / (n + n[i])
            both[i] = np.inf
            radii[i] = np.sqrt(both.min())
        self.threshold = max(float(np.median(radii)), 1.1 * self.threshold)
        self.root, self.entries = Node(self.dims, True), 0
        for one in held:
            self.add(*one)


def cluster_features(df: DataFrame, threshold: float = 0.5, limit: int = LIMIT, features: str = "features") -> DataFrame:
    """leaf, n, mean, m2, threshold: at most ``limit`` summaries of all vectors.

    Each has a radius, the root of m2 / n, of at most ``threshold``, the last column: the one asked for, or the least
    found by growing it while there were more than ``limit``. A tree is built in each partition, in one pass;
    trees are merged FAN_IN at a time, each round a written table. Their n and n·mean add up to the table's count and
    sums. Which vectors share a summary depends on the order of the rows. ``features`` is not NULL; no rows give no rows.
    """
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = None
        for batch in batches:
            for x in batch["x"]:
                x = np.asarray(x, dtype=float)
                tree = tree or FeatureTree(len(x), threshold, limit)
                tree.add(1.0, x, 0.0)
        if tree:
            yield held(tree).assign(part=TaskContext.get().partitionId())

    def held(tree: FeatureTree) -> pd.DataFrame:
        rows = [(int(n), mean.tolist(), m2, tree.threshold) for n, mean, m2 in tree.leaves()]
        return pd.DataFrame(rows, columns=["n", "mean", "m2", "threshold"])

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        tree = FeatureTree(len(group["mean"].iloc[0]), float(group["threshold"].max()), limit)
        for n, mean, m2 in zip(group["n"], group["mean"], group["m2"], strict=True):
            tree.add(float(n), np.asarray(mean, dtype=float), float(m2))
        return held(tree).assign(part=key[0])

    rows = stored(df.select(vector_to_array(features).alias("x")).mapInPandas(build, f"{SUMMARY}, part int"))
    while (rows.agg(F.max("part")).first()[0] or 0) > 0:
        group = F.floor(F.col("part") / FAN_IN).cast("int")
        further = stored(rows.groupBy(group.alias("up")).applyInPandas(merge, f"{SUMMARY}, part int"))
        forget(rows)
        rows = further
    return rows.select(F.monotonically_increasing_id().alias("leaf"), "n", "mean", "m2", "threshold")


@dataclass(frozen=True)
class Dendrogram:
    """Merges in the order of their heights: two nodes, the height, and the node made; nodes below ``size`` are the summaries."""

    size: int
    merges: list[tuple[int, int, float, int]]

    def cut(self, k: int) -> np.ndarray:
        """Cluster of each summary when k are left, numbered by their first summary."""
        root = list(range(self.size + len(self.merges)))
        for a, b, _, made in self.merges[: max(0, self.size - k)]:
            root[a] = root[b] = made

        def top(i: int) -> int:
            while root[i] != i:
                i = root[i]
            return i

        tops = [top(i) for i in range(self.size)]
        number = {t: i for i, t in enumerate(dict.fromkeys(tops))}
        return np.array([number[t] for t in tops], dtype=np.int64)


def ward(n: np.ndarray, mean: np.ndarray) -> Dendrogram:
    """Ward's hierarchy of weighted points, by rounds of reciprocal nearest neighbours.

    The height of a merge is the growth of the squared distances from the means. Merging reciprocal neighbours never brings
    a third cluster nearer, so all pairs of a round merge at once and the hierarchy is that of one merge after another.
    """
    size, n, mean = len(n), n.astype(float), mean.astype(float)
    node, merges, made = np.arange(size), [], size
    while len(n) > 1:
        square = (mean**2).sum(axis=1)
        gap = np.maximum(square[:, None] + square[None] - 2 * mean @ mean.T, 0.0)
        height = gap * (n[:, None] * n[None]) / (n[:, None] + n[None])
        np.fill_diagonal(height, np.inf)
        near = height.argmin(axis=1)
        at = np.arange(len(n))
        a = at[(near[near] == at) & (at < near)]
        if not len(a):  # equal heights in a ring
            a = np.array([int(height.min(axis=1).argmin())])
        b = near[a]
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            merges.append((int(node[i]), int(node[j]), float(height[i, j]), made))
            mean[i] = (n[i] * mean[i] + n[j] * mean[j]) / (n[i] + n[j])
            n[i], node[i] = n[i] + n[j], made
            made += 1
        keep = np.setdiff1d(at, b)
        n, mean, node = n[keep], mean[keep], node[keep]
    # children come before parents at equal heights: they were made earlier
    return Dendrogram(size, sorted(merges, key=lambda m: (m[2], m[3])))


def _collected(summaries: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    rows = summaries.orderBy("leaf").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} summaries")
    return np.array([r["n"] for r in rows], dtype=float), np.array([r["mean"] for r in rows], dtype=float)


def ward_cluster(
    df: DataFrame, k: int = 10, threshold: float = 0.0, limit: int = LIMIT, features: str = "features", out: str = "cluster"
) -> DataFrame:
    """The rows with one of k clusters of Ward's hierarchy, cut where k are left.

    Up to ``limit`` distinct vectors the hierarchy is that of the vectors themselves; of more it is that of at most
    ``limit`` summaries (``cluster_features``), weighted by their rows, and each row goes with the summary of the nearest
    mean. With a ``threshold`` near vectors are summarised in any case. Fewer than k vectors are a cluster each; no rows give no rows.
    """
    n, mean = _collected(stored(cluster_features(df, threshold, limit, features)), limit)
    labels = ward(n, mean).cut(k) if len(n) else np.zeros(0, dtype=np.int64)
    return df.withColumn(out, _nearest(mean, labels)(vector_to_array(features)))


def _nearest(mean: np.ndarray, labels: np.ndarray):
    """Column function: the label of the nearest of a bounded number of points."""
    square = (mean**2).sum(axis=1) if len(mean) else np.zeros(0)

    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        found = []
        for at in range(0, len(x), 4096):
            part = np.stack(x.iloc[at : at + 4096].to_numpy()).astype(float)
            found.append(labels[(square[None] - 2 * part @ mean.T).argmin(axis=1)])
        return pd.Series(np.concatenate(found) if found else [], dtype="int32")

    return nearest


def euclidean_silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster", limit: int = LIMIT) -> DataFrame:
    """silhouette, lower, upper: the mean silhouette under Euclidean distance, and the interval it lies in.

    A row's distances to the members of a cluster are bounded by summaries of the cluster's members: their mean is no less
    than the distance from the members' mean and no more than the root of the mean square, which (n, mean, m2) give exactly.
    Members share a summary if they lie in one leaf of a feature tree, so up to ``limit`` distinct vectors the
    interval is a point; beyond, ``silhouette`` is its middle. Work is rows times summaries. A row alone in its
    cluster scores 0; NULL for fewer than two clusters.
    """
    leaves = stored(cluster_features(df, 0.0, limit, features))
    _, mean = _collected(leaves, limit)
    points = df.select(F.col(cluster).alias("c"), F.col(features).alias("v"))
    points = points.withColumn("leaf", _nearest(mean, np.arange(len(mean)))(vector_to_array("v")))
    groups = points.groupBy("c", "leaf").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("v")).alias("m"), Summarizer.variance(F.col("v")).alias("s"))
    rows = groups.limit(MOST_GROUPS + 1).collect()
    if len(rows) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups of one cluster and leaf")
    names = {c: i for i, c in enumerate(sorted({r["c"] for r in rows}, key=lambda c: (c is None, c)))}
    owner = np.array([names[r["c"]] for r in rows], dtype=np.int64)
    n = np.array([r["n"] for r in rows], dtype=float)
    middle = np.array([r["m"].toArray() for r in rows])
    spread = np.array([r["s"].toArray().sum() * (r["n"] - 1) / r["n"] if r["n"] > 1 else 0.0 for r in rows])
    sizes = np.bincount(owner, weights=n, minlength=len(names)) if len(rows) else np.zeros(0)
    member = np.zeros((len(rows), len(names)))
    member[np.arange(len(rows)), owner] = n

    def score(inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
        most = np.maximum(inner, outer)
        return np.divide(outer - inner, most, out=np.zeros_like(most), where=most > 0)

    @F.pandas_udf("struct<lower: double, upper: double>")
    def bounds(x: pd.Series, c: pd.Series) -> pd.DataFrame:
        parts = [np.zeros((0, 2))]
        for at in range(0, len(x), 512):
            part = np.stack(x.iloc[at : at + 512].to_numpy()).astype(float)
            own = np.array([names[None if pd.isna(v) else v] for v in c.iloc[at : at + 512]])
            # differences, not squares of sums: equal vectors lie at zero
            gap = np.stack([((middle - p) ** 2).sum(axis=1) for p in part])
            rest = np.arange(len(part))
            sides = []
            for total in (np.sqrt(gap) @ member, np.sqrt(gap + spread) @ member):
                inner = total[rest, own] / np.maximum(sizes[own] - 1, 1)
                other = total / sizes
                other[rest, own] = np.inf
                sides.append((inner, other.min(axis=1)))
            alone = sizes[own] == 1
            low, high = score(sides[1][0], sides[0][1]), score(sides[0][0], sides[1][1])
            parts.append(np.where(alone[:, None], 0.0, np.stack([low, high], axis=1)))
        return pd.DataFrame(np.concatenate(parts), columns=["lower", "upper"])

    if len(names) < 2:
        none = F.lit(None).cast("double")
        return df.agg(none.alias("silhouette"), none.alias("lower"), none.alias("upper"))
    each = points.select(bounds(vector_to_array("v"), F.col("c")).alias("b"))
    out = each.agg(F.avg("b.lower").alias("lower"), F.avg("b.upper").alias("upper"))
    return out.select(((F.col("lower") + F.col("upper")) / 2).alias("silhouette"), "lower", "upper")
