"""Near vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tests.llm.plain import rows_of
from tickloom.llm import vectors
from tickloom.llm.vectors import interval_join, near_vectors, projected, unit, united

COLUMNS = ["vec_id", "n_links", "component_id", "kept"]
SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, key string"


def brute(rows, least=0.98) -> list[tuple]:
    """Cosines of all pairs; ids that can link are nodes."""
    good = []
    for k, (i, v, label) in enumerate(rows):
        x = np.array([np.nan if e is None else np.float32(e) for e in v or []], dtype=np.float64)
        if i is not None and label is not None and len(x) and np.isfinite(x).all() and x.any():
            good.append((k, i, x, label))
    root, links = {i: i for _, i, _, _ in good}, dict.fromkeys(range(len(rows)), 0)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (k, i, x, a) in enumerate(good):
        for m, j, y, b in good[:n]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[k] += 1
                links[m] += 1
                p, q = sorted((top(i), top(j)))
                root[q] = p
    able = {k for k, *_ in good}
    out = []
    for k, (i, _, _) in enumerate(rows):
        component = top(i) if k in able else i
        out.append((i, links[k], component, i == component or i is None))
    return sorted(out, key=str)


def clouds(rng, sizes, dims, spread) -> list[tuple]:
    """Groups of near vectors of one label each, some of them copies, and lone vectors between."""
    rows, i = [], 0
    for label, size in enumerate(sizes):
        middle = rng.normal(size=dims)
        for _ in range(size):
            v = middle + rng.normal(size=dims) * rng.choice([0, spread, spread, 10 * spread])
            rows.append((int(i), (v * rng.choice([1, 3])).tolist(), label % 3))
            i += 1
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], SCHEMA).repartition(3)


def test_groups_are_united():
    root = np.arange(8)
    united(root, np.array([5, 1, 7]), np.array([4, 2, 5]))
    assert root.tolist() == [0, 1, 1, 3, 4, 4, 6, 4]


def test_skipped_intervals_hold_no_links():
    rng = np.random.default_rng(1)
    v = unit(np.concatenate([rng.normal(size=(300, 12)), rng.normal(size=(1, 12)) + 0.05 * rng.normal(size=(200, 12))]))
    basis = {12: np.linalg.svd(v)[2][:8].T}
    p = projected(v, basis)
    order = np.lexsort(np.floor(p / 0.2).T[::-1])
    v, p = v[order], p[order]
    got, seen = np.zeros((500, 500), dtype=bool), 0
    for a, c, hit in interval_join(v, v, p, p, 0.98):
        got[a : a + hit.shape[0], c : c + hit.shape[1]] = hit
        seen += hit.size
    assert (got == (v @ v.T >= 0.98)).all() and seen < 250_000


@pytest.mark.parametrize(("block", "small", "spread"), [(2048, 128, 0.05), (7, 2, 0.05), (16, 4, 0.002)])
def test_operator_equals_brute_force(spark, monkeypatch, block, small, spread):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "SMALL", small)
    monkeypatch.setattr(vectors, "CHILDREN", 3)
    rows = clouds(np.random.default_rng(block), [60, 40, 1, 30, 5, 1, 1, 60], 10, spread)
    got = near_vectors(frame(spark, rows))
    assert got.columns == COLUMNS
    want = brute(rows)
    assert rows_of(got, *COLUMNS) == want
    assert sum(r[1] for r in want) > 1000 and len({r[2] for r in want}) > 5


def test_groups_of_near_copies_are_settled_whole(spark, monkeypatch):
    """Blocks inside one dense group are never compared."""
    monkeypatch.setattr(vectors, "BLOCK", 8)
    monkeypatch.setattr(vectors, "CHILDREN", 4)
    seen = []
    original = vectors.compared
    monkeypatch.setattr(vectors, "compared", lambda pairs, *rest: (seen.append(pairs.count()), original(pairs, *rest))[1])
    rng = np.random.default_rng(9)
    rows = [(i, (np.ones(6) + 0.001 * rng.normal(size=6)).tolist(), 1) for i in range(400)]
    got = near_vectors(frame(spark, rows))
    assert rows_of(got, *COLUMNS) == sorted(((i, 399, 0, i == 0) for i in range(400)), key=str)
    assert seen == [0]


def test_odd_rows(spark):
    one, other = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [(1, one, 1), (2, one, 2), (3, one, None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0, 0.0], 1),
            (7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 3.0], 1), (None, one, 1),
            (10, other, 1), (10, other, 1), (10, [-9.0, 2.0, 3.0], 1), (11, [1.0, 2.0], 1), (12, [2.0, 4.0], 1),
            (13, [-9.0, 2.0, 3.0], 1), (14, [1e-30, 2e-30, 3e-30], 1), (15, [-0.0, 1.0, 0.0], 2), (16, [0.0, 1.0, -0.0], 2)]
    assert rows_of(near_vectors(frame(spark, rows)), *COLUMNS) == brute(rows)
    assert near_vectors(frame(spark, rows).limit(0)).collect() == []
    assert rows_of(near_vectors(frame(spark, [(4, None, 1), (5, one, 1)])), *COLUMNS) == [(4, 0, 4, True), (5, 0, 5, True)]
    with pytest.raises(ValueError):
        near_vectors(frame(spark, rows), least=1.0)
