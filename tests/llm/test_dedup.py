"""Near-duplicates, components, substrings and decontamination against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

import corpus_pipeline
from tests.llm.plain import fold, rows_of, words_of
from tickloom.llm import neardup
from tickloom.llm.components import components
from tickloom.llm.decontaminate import contained_items, without_items
from tickloom.llm.neardup import near_duplicates, without_copies
from tickloom.llm.substrings import Automaton, substring_dedup

ODD = [(1, None), (2, ""), (3, "one two"), (4, "ONE two"), (5, "one two"), (6, " \n ")]


def groups(edges):
    root: dict = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {x: top(x) for x in root}


def shingles(text):
    w = words_of(fold(text))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)]
    df = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a bigint, b bigint")
    want = {x: c for x, c in groups(edges).items() if any(x in e and e[0] != e[1] for e in edges)}
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


def families(rng, n, size, swaps):
    """Groups of texts that differ in a few words, near the limit of similarity."""
    out = []
    for _ in range(n):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(100)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randint(0, swaps)):
                text[rng.randrange(100)] = f"v{rng.randint(0, 10**6)}"
            out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(make_docs, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(5)
    texts = families(rng, 5, 14, 4)
    rng.shuffle(texts)
    rows = ODD + [(10 + i, t) for i, t in enumerate(texts)]
    sets = {i: shingles(t) for i, t in rows}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    comp = groups(edges)
    want = sorted(((i, len(s), comp.get(i, i), comp.get(i, i) == i) for i, s in sets.items()), key=str)
    docs = make_docs(*rows)
    assert rows_of(near_duplicates(docs), "doc_id", "n_shingles", "component_id", "kept") == want
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, *_, k in want if k}


@pytest.mark.parametrize("block", [512, 4])
def test_copies_from_80_percent(spark, make_docs, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = [(10 + i, t) for i, t in enumerate(families(random.Random(9), 8, 10, 4))]
    sets = {i: shingles(t) for i, t in rows}
    share = {(a, b): 100 * len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    kept = {}
    for percent in (80, 85):
        comp = groups([e for e, s in share.items() if s >= percent])
        kept[percent] = {i for i in sets if comp.get(i, i) == i}
    docs = make_docs(*rows)
    staged = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
    assert kept[80] < kept[85]
    assert {r["doc_id"] for r in staged.collect()} == kept[80]
    assert {r["doc_id"] for r in without_copies(docs).collect()} == kept[85]
    with pytest.raises(ValueError):
        near_duplicates(docs, percent=79)


def test_near_duplicates_odd_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"z{i}" for i in range(40))
    docs = make_docs((9, text), (9, text), (8, other), (9, other), (None, text), (None, None))
    got = rows_of(near_duplicates(docs), "doc_id", "component_id", "kept")
    assert got == [(8, 8, True), (9, 8, False), (9, 8, False), (9, 8, False), (None, None, True), (None, None, True)]
    assert near_duplicates(docs.limit(0)).count() == 0
    assert without_copies(make_docs((9, text), (9, text), (None, text))).count() == 2


def brute_removed(rows, window=13):
    first: dict[tuple, int] = {}
    for i, t in sorted(((i, t) for i, t in rows if i is not None)):
        w = words_of(t)
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j:j + window]), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        keep = [True] * len(w)
        for j in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[j:j + window])] < i:
                keep[j:j + window] = [False] * window
        left = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((i, len(w), keep.count(False), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard", [20_000, 2])
def test_substrings(make_docs, monkeypatch, shard):
    from tickloom.llm import substrings

    monkeypatch.setattr(substrings, "SHARD", shard)
    rng = random.Random(6)
    passages = [[f"p{k}x{i}" for i in range(rng.randint(11, 60))] for k in range(6)]
    rows = [(1, None), (2, ""), (3, "a " * 30), (4, "b a " + "a " * 20), (5, "a " * 12), (None, "a " * 30)]
    for d in range(10, 60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += [f"u{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 15))]
            p = rng.choice(passages)
            a = rng.randint(0, 5)
            words += p[a:len(p) - rng.randint(0, 5)]
        rows.append((d, " ".join(words)))
    rows += [(70, rows[-1][1]), (71, "  ".join(rows[-1][1].split())), (12, None)]
    docs = make_docs(*[r for r in rows if r != (12, None)])
    want = brute_removed([r for r in rows if r != (12, None)])
    assert rows_of(substring_dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert substring_dedup(docs.limit(0)).count() == 0


def test_substrings_repeated_ids(make_docs):
    text = " ".join(f"w{i}" for i in range(30))
    docs = make_docs((5, text), (5, text), (5, "x " + text), (6, text + " y"))
    got = rows_of(substring_dedup(docs), "doc_id", "n_words", "n_removed")
    assert got == [(5, 30, 0), (5, 30, 0), (5, 31, 0), (6, 31, 30)]


def test_automaton_holds_all_substrings():
    rng = random.Random(7)
    lists = [[rng.randint(0, 2) for _ in range(rng.randint(1, 25))] for _ in range(30)]
    for window in (1, 3, 5):
        automaton = Automaton()
        first: dict[tuple, int] = {}
        for label, words in enumerate(lists):
            automaton.add(words, label)
            for j in range(len(words) - window + 1):
                first.setdefault(tuple(words[j:j + window]), label)
        for words in [*lists, [rng.randint(0, 3) for _ in range(80)]]:
            assert automaton.firsts(words, window) == [
                first.get(tuple(words[j:j + window])) for j in range(len(words) - window + 1)]


def test_contained_items(make_docs, spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"b{rng.randint(0, 400)}" for _ in range(n))) for i, n in enumerate([1, 3, 5, 9, 20, 33, 60])]
    items += [(90, None), (91, ""), (92, items[4][1].upper()), (None, "q w e r t y")]
    rows = [(1, None), (2, ""), (3, "b1"), (None, items[4][1])]
    for d in range(10, 50):
        words = [f"n{rng.randint(0, 999)}" for _ in range(rng.randint(0, 300))]
        part = items[rng.randrange(7)][1].split()
        for _ in range(rng.randint(0, 2)):
            part[rng.randrange(len(part))] = "changed"
        words[5:5] = part
        rows.append((d, " ".join(words)))

    def contained(item, text):
        q = words_of(fold(item))
        n = min(5, len(q))
        own = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)} if q else set()
        w = words_of(fold(text))
        shared = own & {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}
        return (len(shared), len(own)) if own and 10 * len(shared) >= 8 * len(own) else None

    want = sorted(((d, i, *c) for d, t in rows if d is not None for i, x in items if i is not None
                   if (c := contained(x, t))), key=str)
    docs, bench = make_docs(*rows), spark.createDataFrame(items, "item_id bigint, text string")
    assert len(want) > 10
    assert rows_of(contained_items(docs, bench), "doc_id", "item_id", "n_shared", "n_item") == want
    left = without_items(docs, bench)
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in rows} - {w[0] for w in want}
    assert contained_items(docs, bench.limit(0)).count() == 0 and contained_items(docs.limit(0), bench).count() == 0
