"""License spans against brute force over insertions, deletions, repeats and mixtures."""

from __future__ import annotations

import random

import pytest

from tests.llm.plain import rows_of
from tickloom.llm import licenses
from tickloom.llm.licenses import DRIFT, K, LEAST, TEMPLATES

NAMES = [t for _, t in TEMPLATES]


def brute(text: str) -> tuple[set[str], float]:
    """Labels of the templates' spans and the largest share of a template's words, by sets of places of each diagonal."""
    words, found = text.split(), []
    for label, template in TEMPLATES:
        t_words = template.split()
        n_grams = len(t_words) - K + 1
        at: dict[int, set[int]] = {}
        for j in range(n_grams):
            for i in range(len(words) - K + 1):
                if words[i:i + K] == t_words[j:j + K]:
                    at.setdefault(i - j, set()).add(j)
        for d in at:
            near = [e for e in at if d <= e <= d + DRIFT]
            if len(set().union(*(at[e] for e in near))) < LEAST * n_grams:
                continue
            places = [min((e + j for e in near if 0 <= e + j < len(words) and words[e + j] == w), default=None)
                      for j, w in enumerate(t_words)]
            places = [p for p in places if p is not None]
            if len(places) >= LEAST * len(t_words):
                found.append((label, len(places), min(places), max(places), len(places) / len(t_words)))
    kept = [f for f in found if not any(
        o[0] != f[0] and o[1] > f[1] and 2 * (min(o[3], f[3]) - max(o[2], f[2]) + 1) >= f[3] - f[2] + 1 for o in found)]
    return {f[0] for f in kept}, max((f[4] for f in kept), default=0.0)


def changed(rng: random.Random, template: str) -> str:
    words = template.split()
    for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
        i = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.35:
            words[i:i] = rng.choices(["foo", "bar", "the", "of"], k=rng.randint(1, 4))
        elif kind < 0.7:
            del words[i : i + rng.randint(1, 3)]
        elif kind < 0.85:
            words[i] = "qux"
        else:
            words[i:i] = words[i : i + rng.randint(2, 6)]
        if not words:
            return ""
    return " ".join(words)


def test_spans_equal_brute_force(make_docs):
    rng = random.Random(8)
    texts = []
    for _ in range(160):
        parts = [changed(rng, rng.choice(NAMES)) for _ in range(rng.randint(1, 3))]
        parts += rng.choices(["foo bar baz", "all rights reserved", "all rights reserved " * 6, "public license version"], k=2)
        rng.shuffle(parts)
        texts.append(" ".join(parts))
    got = licenses.license_scan(make_docs(*enumerate(texts)))
    want = []
    for i, text in enumerate(texts):
        labels, best = brute(text)
        base = {v for p, v in licenses.PHRASES.items() if f" {p} " in f" {text} "}
        want.append((i, ",".join(sorted(labels | base)), 1.0 if base else round(best, 9)))
    rows = [(i, labels, round(score, 9)) for i, labels, score in rows_of(got, "doc_id", "labels", "score")]
    assert sorted(rows) == sorted(want)
    assert len({w[1] for w in want}) > 30


@pytest.mark.parametrize(("text", "labels"), [
    ("all rights reserved " * 7, "reserved"),
    ("all rights reserved " * 20 + NAMES[-1], "proprietary,reserved"),
    (NAMES[-1] + " x" * 30 + " all rights reserved" * 9 + " y" * 30 + " " + NAMES[-1], "proprietary,reserved"),
    ("licensed under cc by nc 4 0", "cc-by,cc-by-nc"), ("licensed under cc by 4 0", "cc-by,cc-by-4.0"),
    (NAMES[4], "gpl,gpl-2.0"), (NAMES[5], "gpl,gpl-3.0"), (NAMES[4] + " and " + NAMES[5], "gpl,gpl-2.0,gpl-3.0"),
    ("w " * 40_000 + NAMES[8] + " w" * 40_000, "mit"), ("all rights reserved " * 15_000, "reserved"),
])
def test_labels(make_docs, text, labels):
    docs = make_docs((1, text), (2, None), (None, text))
    got = {r["doc_id"]: r["labels"] for r in licenses.license_scan(docs).collect()}
    assert got == {1: labels, 2: "", None: labels}
