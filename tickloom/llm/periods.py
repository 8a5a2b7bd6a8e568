"""Periodic runs of words: a dictionary of basic factors proposes periods, which are extended and made distinct."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import bounded_batches, hash_words, in_batches, mix, utf8

#: A run has at least this many words, and two of its periods.
LEAST = 12
#: Groups of occurrences of one factor that begin less than twice its length away: gaps between groups exceed half of it.
GROUPS = 3

#: Beyond every place.
FAR = 1 << 60

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def named(values: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the values at some of ``n`` places, and those places whose value is there twice or more.

    Equal values have equal names; all other places have a name of their own.
    """
    _, name, count = np.unique(values, return_inverse=True, return_counts=True)
    names = np.arange(n, dtype=np.int64) + n
    again = count[name] > 1
    names[places[again]] = name[again]
    return names, places[again]


def basic_factors(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 1, 2, 4, … items: names of the factors that begin at each place, and the places whose factor occurs again.

    Only factors whose halves occur again are looked at; the list ends with the last length at which any does.
    """
    names, again = named(ids, np.arange(len(ids)), len(ids))
    levels, width = [], 1
    while len(again):
        levels.append((names, again))
        n = len(names) - width
        places = again[again < n]
        places = places[np.isin(places + width, again, assume_unique=True)]
        pairs = names[places] * len(ids) + names[places + width]
        names, again = named(pairs, places, max(n, 0))
        width *= 2
    return levels


def successors(names: np.ndarray, again: np.ndarray) -> np.ndarray:
    """The next place with the same name; FAR if there is none."""
    order = again[np.argsort(names[again], kind="stable")]
    after = np.full(len(names), FAR, dtype=np.int64)
    same = names[order[1:]] == names[order[:-1]]
    after[order[:-1][same]] = order[1:][same]
    return after


def proposals(names: np.ndarray, again: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of ``width`` to ``2 * width - 1`` words that the occurrences of one length propose.

    Successors at most half a width away belong to one arithmetic progression, whose difference is the factor's
    own period; the next progression begins more than half a width further. A run of period q in that range
    has, from its first place, the start of a progression at distance q, or the end of one at distance q from the end of its own.
    """
    n = len(names)
    after = successors(names, again)
    place = np.arange(n, dtype=np.int64)
    near = after - place <= width // 2
    # the end of each place's progression: pointers are doubled along near successors
    end = np.where(near, after, place)
    while True:
        further = end[end]  # an end points to itself
        if np.array_equal(further, end):
            break
        end = further

    def follow(pointer: np.ndarray, at: np.ndarray) -> np.ndarray:
        inside = at < n
        return np.where(inside, pointer[np.where(inside, at, 0)], FAR)

    found = []
    # a place whose factor does not come again in reach proposes nothing
    start_from = np.flatnonzero(follow(after, end) - place < 2 * width)
    at = start_from
    for _ in range(GROUPS):
        at = follow(after, follow(end, at))
        found.append((start_from, at - start_from))
    ends_from = np.flatnonzero((end == place) & (after - place < 2 * width))
    at = ends_from
    for _ in range(GROUPS):
        at = follow(end, follow(after, at))
        found.append((ends_from, at - ends_from))
    places, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = (periods >= width) & (periods < 2 * width)
    return places[keep], periods[keep]


def extended(factors: list[np.ndarray], n: int, places: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and stop of the longest stretch of each period around each place, by comparing names of falling length."""
    right, left = places.copy(), places.copy()
    for k in range(len(factors) - 1, -1, -1):
        names, width = factors[k], 1 << k
        while True:  # the longest factors may fit several times
            fits = right + periods + width <= n
            a, b = np.where(fits, right, 0), np.where(fits, right + periods, 0)
            fits &= names[a] == names[b]
            right = right + np.where(fits, width, 0)
            if k < len(factors) - 1 or not fits.any():
                break
        while True:
            fits = left - width >= 0
            a, b = np.where(fits, left - width, 0), np.where(fits, left - width + periods, 0)
            fits &= b + width <= n
            fits &= names[a] == names[np.where(fits, b, 0)]
            left = left - np.where(fits, width, 0)
            if k < len(factors) - 1 or not fits.any():
                break
    return left, right + periods


def runs(ids: np.ndarray, least: int = LEAST) -> np.ndarray:
    """start, length, period of every run of a sequence, by start and period.

    A run is a maximal stretch of at least ``least`` items and two of its smallest periods.
    """
    if len(ids) < least:
        return np.zeros((0, 3), dtype=np.int64)
    levels = basic_factors(ids)
    if not levels:
        return np.zeros((0, 3), dtype=np.int64)
    found = [proposals(names, again, 1 << k) for k, (names, again) in enumerate(levels)]
    places, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((places, periods))
    places, periods = places[order], periods[order]
    # neighbouring places that propose one period lie in one stretch
    new = np.ones(len(places), dtype=bool)
    new[1:] = (periods[1:] != periods[:-1]) | (places[1:] > places[:-1] + 1)
    places, periods = places[new], periods[new]
    first, stop = extended([names for names, _ in levels], len(ids), places, periods)
    keep = stop - first >= np.maximum(least, 2 * periods)
    first, stop, periods = first[keep], stop[keep], periods[keep]
    # a stretch has one smallest period; the others are its multiples
    order = np.lexsort((periods, stop, first))
    first, stop, periods = first[order], stop[order], periods[order]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (first[1:] != first[:-1]) | (stop[1:] != stop[:-1])
    out = np.stack([first, stop - first, periods], axis=1)[new]
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of(texts: list[bytes], least: int = LEAST) -> Iterator[np.ndarray]:
    """The runs of each text. Texts of a batch are one sequence, parted by items that occur once; they share no items."""
    for _, part in in_batches(texts):
        words, at = hash_words(part)
        owners = np.repeat(np.arange(len(part), dtype=np.uint64), np.diff(at))
        joined = np.insert(words + mix(owners + np.uint64(1)), at[1:], mix(np.arange(len(part), dtype=np.uint64)))
        found = runs(joined, least)
        starts = at[:-1] + np.arange(len(part))
        owner = np.searchsorted(starts, found[:, 0], side="right") - 1
        found[:, 0] -= starts[owner] if len(found) else 0
        cuts = np.searchsorted(owner, np.arange(len(part) + 1))
        for i in range(len(part)):
            yield found[cuts[i] : cuts[i + 1]]


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not len(found):
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, found[:, 0] + found[:, 2], 1)
    np.add.at(edge, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge)[:-1] == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of every row; one pass, no shuffle.

    Words are parted by blanks and compared as 64-bit hashes; ``start`` and ``length`` count words. A run has at
    least ``least`` words and two of its smallest periods, and no neighbouring word continues it. ``collapsed`` is the text
    without the words that a run holds after its first period, words joined by one blank. Null and empty
    texts have no words, no runs and an empty ``collapsed``; null ids stay null; repeated rows are searched each; other columns are not
    read; no rows give no rows. Time is n log n in a text's words; memory is 8 bytes for each word and doubling
    of length up to the longest factor that occurs twice.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1).to_pylist())
            n_words, lists, kept = [], [], []
            for text, found in zip(texts, runs_of(texts, least), strict=True):
                words = text.split()
                n_words.append(len(words))
                lists.append([{"start": s, "length": n, "period": p} for s, n, p in found.tolist()])
                kept.append(b" ".join(collapsed(words, found)).decode("utf-8", "surrogatepass"))
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(lists, kind), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
