"""What the operators share: words as 64-bit hashes in numpy, batches, words in SQL, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that end a word, as a Java and Python pattern.
WORD_BREAKS = "[\\x20\\x09-\\x0D]+"

_GAPS = np.zeros(256, dtype=bool)
_GAPS[[32, 9, 10, 11, 12, 13]] = True
_BYTES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BATCH_BYTES = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 2 * BATCH_BYTES)
        base = np.full(n, _BASE, dtype=np.uint64)
        back = np.full(n, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        base[0] = back[0] = 1
        _powers, _inverses = np.cumprod(base, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and where each text's words start (one more than texts).

    A word's hash is a polynomial of its bytes, taken as a difference of running sums.
    """
    if not texts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8)
    _grow(len(buf) + 1)
    gap = _GAPS[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[buf] * _powers[: len(buf)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _inverses[starts])
    sizes = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
    return words, np.searchsorted(starts, bounds)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for j in range(n):
        total = total * _STEP + words[j : j + len(total)]
    return mix(total)


def stretch_hashes(words: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of the words ``first .. stop`` of each stretch, by differences of running sums."""
    _grow(len(words) + 1)
    sums = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _powers[: len(words)], out=sums[1:])
    return mix(mix((sums[stop] - sums[first]) * _inverses[first]) + (stop - first).astype(np.uint64)).view(np.int64)


def shingle_set(words: np.ndarray, n: int = 5) -> np.ndarray:
    """Distinct ``n``-word shingles, sorted; of fewer words the whole sequence; none of no words."""
    if 0 < len(words) < n:
        n = len(words)
    return np.unique(grams(words, n))


def in_batches(texts: list[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of whole texts of about ``limit`` bytes together, with the place of the first."""
    at, part, size = 0, [], 0
    for i, t in enumerate(texts):
        part.append(t)
        size += len(t)
        if size >= limit:
            yield at, part
            at, part, size = i + 1, [], 0
    if part:
        yield at, part


def utf8(texts, lower: bool = False) -> list[bytes]:
    """Texts as UTF-8, missing ones empty; ``lower`` folds A-Z alone."""
    out = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    return [t.translate(LOWER) for t in out] if lower else out


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Have Arrow batches of at most ``rows`` rows in this session: whole texts make the default ones large."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= rows:
        spark.conf.set(setting, rows)


def text_of(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("string")


def sql_words(text: Column) -> Column:
    """The words of a text as an array."""
    return F.filter(F.split(text, WORD_BREAKS), lambda w: w != "")


def fold(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has been counted and has at most ``rows`` rows; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
