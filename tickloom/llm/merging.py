"""Pair merges over ragged arrays: many short sequences advance together, each by its lowest-rank pair."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

NEVER = np.iinfo(np.int64).max


class Pairs:
    """Which two symbols join, into which, and in which order; looked up in open-addressed arrays.

    Symbols are ids below ``width``; -1 is a symbol that never joins.
    """

    def __init__(self, merges: Iterable[tuple[int, int, int, int]], width: int):
        self.width = width
        self.table = {a * width + b: (rank, into) for a, b, rank, into in merges}
        self.bits = max(4, (len(self.table) * 4).bit_length())
        n = 1 << self.bits
        self.keys = np.full(n, -2, dtype=np.int64)  # -2: an empty slot
        self.ranks, self.into = np.full(n, NEVER, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        for key, slot in zip(self.table, self.slot(np.array(list(self.table), dtype=np.int64)).tolist(), strict=True):
            while self.keys[slot] != -2:
                slot = (slot + 1) % n
            self.keys[slot] = key
            self.ranks[slot], self.into[slot] = self.table[key]

    def slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of each pair; NEVER where the two don't join."""
        key = np.where((left < 0) | (right < 0), -1, left * self.width + right)
        at = self.slot(key)
        seen = self.keys[at]
        open_ = np.flatnonzero((seen != key) & (seen != -2))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.keys)
            seen = self.keys[at[open_]]
            open_ = open_[(seen != key[open_]) & (seen != -2)]
        return self.ranks[at], self.into[at]

    def merge(self, sym: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols that survive, and the sequence of each; sequences are numbered in rising order.

        Every round, each sequence that still moves joins its leftmost pair of lowest rank.
        """
        rest: list[tuple[np.ndarray, np.ndarray]] = []
        nxt = np.where(np.r_[owner[1:] == owner[:-1], False], np.r_[sym[1:], -1], -1) if len(sym) else sym
        rank, into = self.find(sym, nxt)
        while len(sym):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, first)
            sizes = np.diff(np.r_[first, len(sym)])
            if not (moving := best != NEVER).all():
                keep = np.repeat(moving, sizes)
                rest.append((sym[~keep], owner[~keep]))
                sym, owner, rank, into = sym[keep], owner[keep], rank[keep], into[keep]
                if not len(sym):
                    break
                best, sizes = best[moving], sizes[moving]
            hit = np.flatnonzero(rank == np.repeat(best, sizes))
            at = hit[np.r_[True, owner[hit][1:] != owner[hit][:-1]]]
            sym[at] = into[at]
            keep = np.ones(len(sym), dtype=bool)
            keep[at + 1] = False
            new = at - np.arange(len(at))
            sym, owner, rank, into = sym[keep], owner[keep], rank[keep], into[keep]
            touched = np.concatenate((new, new[new > 0] - 1))
            after = np.minimum(touched + 1, len(sym) - 1)
            same = (touched + 1 < len(sym)) & (owner[after] == owner[touched])
            rank[touched], into[touched] = self.find(sym[touched], np.where(same, sym[after], -1))
        if not rest:
            return sym, owner
        out, owners = (np.concatenate(x) for x in zip(*rest, strict=True))
        by = np.argsort(owners, kind="stable")
        return out[by], owners[by]

    def count_long(self, sym: list[int]) -> int:
        """How many symbols of one long sequence survive the same merges, by a heap of pairs in n log n."""
        import heapq

        n = len(sym)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(x: int, y: int) -> None:
            if 0 <= x and y < n and sym[x] >= 0 and sym[y] >= 0 and (m := self.table.get(sym[x] * self.width + sym[y])):
                heapq.heappush(heap, (m[0], x, sym[x], sym[y], m[1]))

        for i in range(n - 1):
            push(i, i + 1)
        alive, count = [True] * n, n
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or sym[i] != a or sym[j] != b:
                continue
            sym[i], alive[j], count = t, False, count - 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            push(before[i], i)
            push(i, k)
        return count
