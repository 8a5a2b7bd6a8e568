"""Periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.plain import rows_of, words_of
from tickloom.llm import queries
from tickloom.llm.periods import LEAST, periodic_runs, runs, runs_of


def brute(words, least=LEAST) -> list[tuple[int, int, int]]:
    """Every period in rising order, every stretch that keeps it; the first period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def sequence(rng: random.Random) -> list[int]:
    size, letters = rng.randint(1, 90), rng.choice([1, 2, 2, 3, 4])
    if rng.random() < 0.4:
        return [rng.randrange(letters) for _ in range(size)]
    out: list[int] = []
    while len(out) < size:
        root = [rng.randrange(letters) for _ in range(rng.randint(1, 20))]
        if rng.random() < 0.5:  # roots that are nearly periodic themselves
            root = ([rng.randrange(letters) for _ in range(rng.randint(1, 4))] * 20)[: rng.randint(3, 25)]
        out += (root * 6)[: rng.randint(len(root), 4 * len(root))]
    return out * 2 if rng.random() < 0.3 else out


@pytest.mark.parametrize("least", [2, 3, 6, LEAST])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(1500):
        words = sequence(rng)
        got = [tuple(map(int, r)) for r in runs(np.array(words, dtype=np.int64), least)]
        assert got == brute(words, least), words


def test_texts_of_a_batch_are_apart():
    texts = [b"a b " * 6, b"", b"a b " * 6, b"b", b"x " * 20]
    got = [[tuple(map(int, r)) for r in found] for found in runs_of(texts)]
    assert got == [[(0, 12, 2)], [], [(0, 12, 2)], [], [(0, 20, 1)]]


def test_operator_keeps_every_row(spark, make_docs):
    rows = [(1, None), (2, ""), (3, " \n "), (4, "a b c " * 5), (4, "a b c " * 5), (None, "x\ty " * 7), (6, "é " * 12),
            (7, "one two three")]
    got = {r["doc_id"]: r for r in periodic_runs(make_docs(*rows)).collect()}
    assert got[1]["runs"] == [] and got[1]["collapsed"] == "" and got[3]["n_words"] == 0
    assert [tuple(r) for r in got[4]["runs"]] == [(0, 15, 3)] and got[4]["collapsed"] == "a b c"
    assert got[None]["collapsed"] == "x y" and got[6]["collapsed"] == "é" and got[7]["collapsed"] == "one two three"
    assert periodic_runs(make_docs(*rows)).count() == len(rows)
    assert periodic_runs(make_docs(*rows).limit(0)).collect() == []


def test_very_long_text(make_docs):
    words = [f"w{i}" for i in range(30_000)]
    text = " ".join(words + words + ["z"] * 40_000)
    got = periodic_runs(make_docs((1, text))).first()
    assert [tuple(r) for r in got["runs"]] == [(0, 60_000, 30_000), (60_000, 40_000, 1)]
    assert len(got["collapsed"].split()) == 30_001


def altered(doc_id, text) -> list[str]:
    words = words_of(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 5, 40, 120])))) for i in range(400)]
    rows += [(900, None), (901, "a b " * 20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for doc_id, text in rows:
        words = altered(doc_id, text)
        found = brute(words)
        gone = {i for a, n, q in found for i in range(a + q, a + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        milli = None if not found else 1000 * best[1] // best[2]
        want.append((doc_id, len(found), *best, milli, sha("".join(f"{a},{n},{q}\n" for a, n, q in found)), sha(kept)))
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = queries.op13_periods(spark, str(tmp_path))
    assert got.columns == columns
    assert rows_of(got, *columns) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 10
