"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.plain import fold, rows_of
from tickloom.llm import queries
from tickloom.llm.spelling import BUCKETS, Letters, disjoint, indexed, probing, spelling_variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts: dict[str, int]) -> list[tuple]:
    forms, rows = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * n:
            forms[w] = best
        rows[w] = len(others)
    out = []
    for w, n in counts.items():
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n, rows[w], counts.get(forms.get(w))))
    return sorted(out, key=str)


def words(rng: random.Random, letters: str, size: int) -> list[str]:
    out = set()
    while len(out) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 11)))
        for _ in range(rng.randint(1, 4)):
            out.add(w)
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            if len(w) < 5:
                break
    return sorted(out)


def test_pivots_are_apart_and_light():
    assert disjoint([0, 1, 2], [1, 0, 1]) == (0, 2)
    assert disjoint([0, 1, 2, 5], [9, 1, 9, 2]) == (1, 3)
    assert disjoint([0, 2, 4, 6], [3, 1, 1, 3]) == (1, 2)


@pytest.mark.parametrize("letters", ["ab", "abcdé", "abcdefghijklmnopqrstuvwxyzñü"])
def test_no_near_pair_is_missed(letters):
    rng = random.Random(len(letters))
    for _ in range(150):
        some = words(rng, letters, rng.randint(2, 40))
        batch = Letters(some)
        counts = np.bincount(batch.bucket, minlength=BUCKETS)
        ranks = np.empty(BUCKETS, dtype=np.int64)
        ranks[np.argsort(counts, kind="stable")] = np.arange(BUCKETS)
        keys, of, last = indexed(batch, ranks, counts)
        probes, by, _ = probing(batch, ranks, counts)
        table: dict[int, set[int]] = {}
        for k, w in zip(keys.tolist(), of.tolist(), strict=True):
            table.setdefault(k, set()).add(w)
        got = {frozenset((w, v)) for k, w in zip(probes.tolist(), by.tolist(), strict=True)
               for v in table.get(k, ()) if last[w] <= last[v] and near(some[w], some[v])}
        want = {frozenset((i, j)) for i in range(len(some)) for j in range(i) if near(some[i], some[j])}
        assert got == want


def test_operator_equals_brute_force(spark):
    rng = random.Random(3)
    counts = {w: rng.choice([0, 1, 2, 3, 4, 8, 16, 100]) for w in words(rng, "abcdé", 400)}
    counts |= {"a" * n: 2 ** (n // 3) for n in range(4, 40)}
    rows = [(w, n, "x") for w, n in counts.items()] + [(None, 5, "x")]
    vocab = spark.createDataFrame(rows, "word string, n bigint, key string")
    got = spelling_variants(vocab)
    assert got.columns == COLUMNS
    assert rows_of(got, *COLUMNS) == brute(counts)


def test_odd_tables(spark):
    schema = "word string, n bigint"
    assert spelling_variants(spark.createDataFrame([], schema)).collect() == []
    got = spelling_variants(spark.createDataFrame([("abcde", 1), ("abcde", 2), ("abcdef", None), ("abd", 9), ("", 1)], schema))
    assert rows_of(got, *COLUMNS) == sorted([
        ("", None, "", 1, 0, None), ("abcde", None, "abcde", 3, 1, None), ("abcdef", "abcde", "abcde", 0, 1, 3),
        ("abd", None, "abd", 9, 0, None)], key=str)
    with pytest.raises(ValueError):
        spelling_variants(spark.createDataFrame([], schema), least_factor=1)


def test_very_long_words(spark):
    long = "ab" * 20_000
    counts = {long: 10, long[:-1]: 4, long[:777] + "x" + long[778:]: 3, "a" * 30_000: 9, "a" * 30_001: 2}
    got = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n bigint"))
    by_word = {r["word"]: r["n_near"] for r in got.collect()}
    assert [by_word[w] for w in counts] == [2, 1, 1, 1, 1]


def test_query_equals_brute_force(spark, make_docs, tmp_path):
    rng = random.Random(4)
    stock = words(rng, "abcdefé", 60)
    texts = [" ".join(rng.choice(stock).upper() if rng.random() < 0.2 else rng.choice(stock)
                      for _ in range(rng.randint(0, 60))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, "12 34 a,b.c Ünï×code"), (1003, "x")]
    make_docs(*rows).write.parquet(f"{tmp_path}/documents.parquet")
    seen: Counter[str] = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", fold(text)):
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            k = h % len(run)
            seen[run[:k] + run[k + 1:] if h % 97 == 0 else run] += 1
    want = brute({w: n for w, n in seen.items() if len(w) >= 5 and n >= 3})
    assert sum(r[1] is not None for r in want) > 5
    assert rows_of(queries.op11_spelling(spark, str(tmp_path)), *COLUMNS) == want
