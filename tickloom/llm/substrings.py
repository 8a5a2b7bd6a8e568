"""Exact substring de-duplication: suffix automata over shards of the reference, streamed for matching statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import bounded_batches, grams, hash_words, in_batches, mix, small, stretch_hashes, utf8
from tickloom.plans.scratch import forget, stored

WINDOW = 13
#: Words of an anchor: every window is filed under its anchor of smallest hash.
ANCHOR = 4
#: Distinct segments of one anchor that an automaton holds; windows of hotter anchors are spread over several.
SHARD = 20_000
BROADCAST_ROWS = 1_000_000


class Automaton:
    """Generalized suffix automaton of word sequences; each state has the first label inserted for it."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.label = [-1], [0], [None]

    def add(self, words: list[int], label: int) -> None:
        """Labels must come in rising order, so that the first is the smallest."""
        last = 0
        for w in words:
            last = self._extend(last, w)
            v = last
            while v > 0 and self.label[v] is None:
                self.label[v] = label
                v = self.link[v]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.label.append(None)
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """The state for the shorter words that reach ``q``, which keeps the longer ones."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.label[clone] = self.label[q]
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def firsts(self, words: list[int], window: int) -> list[int | None]:
        """The smallest label of each window of ``words``, by matching statistics: None if it isn't held."""
        v, matched, out = 0, 0, []
        for j, w in enumerate(words):
            while v and w not in self.next[v]:
                v = self.link[v]
                matched = self.length[v]
            if (q := self.next[v].get(w)) is not None:
                v, matched = q, matched + 1
            if j >= window - 1:
                if matched < window:
                    out.append(None)
                    continue
                while self.length[self.link[v]] >= window:
                    v = self.link[v]
                matched = min(matched, self.length[v])
                out.append(self.label[v])
        return out


def anchors(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of each stretch of windows with one anchor."""
    g = grams(words, ANCHOR)
    wide = window - ANCHOR + 1
    if len(g) < wide:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    at = np.lib.stride_tricks.sliding_window_view(g, wide).argmin(axis=1) + np.arange(len(g) - wide + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return g[at[first]], first, np.diff(np.r_[first, len(at)])


def sequence_hash(words: np.ndarray) -> int:
    """Hash of a whole sequence of words."""
    if not len(words):
        return 0
    place = mix(np.arange(1, len(words) + 1, dtype=np.uint64))
    return int(mix((words * place).sum(keepdims=True) + np.uint64(len(words))).view(np.int64)[0])


def _words(texts: list) -> Iterator[tuple[list[bytes], np.ndarray]]:
    for _, part in in_batches(utf8(texts)):
        hashes, at = hash_words(part)
        for i, t in enumerate(part):
            yield t, hashes[at[i] : at[i + 1]]


def _batches(columns: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def sequences(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, the hash of the words and the digest of the words joined by spaces, of every row."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = [(len(w), sequence_hash(w), hashlib.sha256(b" ".join(t.split())).hexdigest())
                         for t, w in _words(part.column(1).to_pylist())]
                n, seq, sha = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(seq, pa.int64()), pa.array(sha)],
                    names=["doc_id", "n_words", "seq", "sha"])

    return rows.mapInArrow(read, "doc_id bigint, n_words bigint, seq bigint, sha string")


def anchored(rows: DataFrame, window: int) -> DataFrame:
    """h, doc_id, seq, start, n: every stretch of windows under its anchor."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                hs, ids, seqs, starts, ns = [], [], [], [], []
                for doc, (_, words) in zip(part.column(0).to_pylist(), _words(part.column(1).to_pylist()), strict=True):
                    h, start, n = anchors(words, window)
                    if len(h):
                        hs.append(h.view(np.int64))
                        starts.append(start)
                        ns.append(n)
                        ids.append(np.full(len(h), doc, dtype=np.int64))
                        seqs.append(np.full(len(h), sequence_hash(words), dtype=np.int64))
                if hs:
                    yield _batches([np.concatenate(x) for x in (hs, ids, seqs, starts, ns)],
                                   [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()],
                                   ["h", "doc_id", "seq", "start", "n"])

    return rows.mapInArrow(read, "h bigint, doc_id bigint, seq bigint, start int, n int")


def segments(rows: DataFrame, window: int) -> DataFrame:
    """h, c, doc_id, seq, start, words: the words under each shared anchor. ``rows`` has doc_id, text and spots."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["h", "c", "doc_id", "seq", "start", "words"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                listed = part.column(2)
                spots = {k: listed.flatten().field(k).to_numpy() for k in ("h", "seq", "start", "n")}
                ends = np.cumsum(listed.value_lengths().to_numpy())
                columns: list[list] = [[] for _ in names]
                texts = _words(part.column(1).to_pylist())
                for i, (doc, (_, words)) in enumerate(zip(part.column(0).to_pylist(), texts, strict=True)):
                    here = slice(int(ends[i - 1]) if i else 0, int(ends[i]))
                    own = sequence_hash(words)
                    mine = spots["seq"][here] == own
                    first = spots["start"][here][mine].astype(np.int64)
                    stop = first + spots["n"][here][mine] + window - 1
                    raw = words.astype(np.uint32).tobytes()
                    k = len(first)
                    for column, values in zip(columns, (
                            spots["h"][here][mine], stretch_hashes(words, first, stop), np.full(k, doc), np.full(k, own),
                            first, [raw[4 * x : 4 * y] for x, y in zip(first.tolist(), stop.tolist(), strict=True)]),
                            strict=True):
                        column.append(values)
                yield _batches([*(np.concatenate(c) for c in columns[:5]), [w for ws in columns[5] for w in ws]], kinds, names)

    return rows.select("doc_id", "text", "spots").mapInArrow(
        read, "h bigint, c bigint, doc_id bigint, seq bigint, start int, words binary")


def first_documents(distinct: DataFrame, window: int) -> DataFrame:
    """h, c, firsts: the smallest document of each window of each distinct segment.

    ``distinct`` (h, c, doc_id, words) has each segment with its smallest document. A shard is an anchor's
    segments; its automaton takes them in the order of their documents and then streams them again. Anchors
    with more segments than SHARD are spread: a segment goes to the shards of its windows' hashes, and each
    shard answers for its own windows.
    """
    counts = distinct.groupBy("h").count()
    hot = small(counts.where(F.col("count") > SHARD).select("h", F.ceil(F.col("count") / SHARD).cast("int").alias("parts")),
                BROADCAST_ROWS)
    dealt = distinct.join(hot, "h", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    def spread(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for r in frame.itertuples(index=False):
                own = {0} if r.parts == 1 else set(_window_parts(r.words, r.parts, window))
                out += [(r.h, r.c, r.doc_id, r.words, r.parts, p) for p in own]
            yield pd.DataFrame(out, columns=["h", "c", "doc_id", "words", "parts", "part"])

    shards = dealt.select("h", "c", "doc_id", "words", "parts").mapInPandas(
        spread, "h bigint, c bigint, doc_id bigint, words binary, parts int, part int")

    def answer(group: list[tuple]) -> Iterator[tuple]:
        if len(group) == 1 and group[0][4] == 1:
            h, c, doc, words, _, _ = group[0]
            yield h, c, [doc] * (len(words) // 4 - window + 1)
            return
        automaton = Automaton()
        listed = [np.frombuffer(words, dtype=np.uint32).tolist() for _, _, _, words, _, _ in group]
        for (_, _, doc, _, _, _), words in zip(group, listed, strict=True):
            automaton.add(words, doc)
        for (h, c, _, raw, parts, part), words in zip(group, listed, strict=True):
            firsts = automaton.firsts(words, window)
            if parts > 1:
                firsts = [f if p == part else None
                          for f, p in zip(firsts, _window_parts(raw, parts, window), strict=True)]
            yield h, c, firsts

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, group, out = None, [], []
        for frame in frames:
            for r in frame.itertuples(index=False, name=None):
                if (r[0], r[5]) != key:
                    out.extend(answer(group) if group else ())
                    key, group = (r[0], r[5]), []
                group.append(r)
            yield pd.DataFrame(out, columns=["h", "c", "firsts"])
            out = []
        yield pd.DataFrame(list(answer(group)) if group else [], columns=["h", "c", "firsts"])

    return shards.repartition("h", "part").sortWithinPartitions("h", "part", "doc_id", "c").mapInPandas(
        stream, "h bigint, c bigint, firsts array<bigint>")


def _window_parts(words: bytes, parts: int, window: int) -> list[int]:
    return (grams(mix(np.frombuffer(words, dtype=np.uint32).astype(np.uint64)), window) % np.uint64(parts)).tolist()


def without(rows: DataFrame, window: int) -> DataFrame:
    """doc_id, seq, n_removed, sha, kept text of rows (doc_id, text, ranges of windows to cover)."""
    def cover(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            texts = _words(frame["text"].tolist())
            for doc, ranges, (text, hashes) in zip(frame["doc_id"], frame["ranges"], texts, strict=True):
                own, keep = sequence_hash(hashes), np.ones(len(hashes), dtype=bool)
                for r in ranges:
                    if r["seq"] == own:
                        for i in r["places"]:
                            keep[r["start"] + i : r["start"] + i + window] = False
                words = text.split()
                kept = b" ".join([words[i] for i in np.flatnonzero(keep)])
                out.append((doc, own, int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
            yield pd.DataFrame(out, columns=["doc_id", "seq", "n_removed", "sha", "kept"])

    return rows.mapInPandas(cover, "doc_id bigint, seq bigint, n_removed bigint, sha string, kept string")


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(every row's doc_id, n_words, seq, sha and ``copied``, and what is left of those that lose a part).

    ``copied`` rows have the words of a document with a smaller id, and lose all if they fill a window. The
    second table has doc_id, seq, n_removed, sha and the kept words of the rest that lose words.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounded_batches(docs.sparkSession)
    seen = stored(sequences(rows))
    least = seen.where("doc_id IS NOT NULL").groupBy("seq", "n_words").agg(F.min("doc_id").alias("first"))
    whole = stored(seen.join(least, ["seq", "n_words"], "left").withColumn(
        "copied", F.coalesce((F.col("first") < F.col("doc_id")) & (F.col("n_words") >= window), F.lit(False))).drop("first"))
    forget(seen)
    one = whole.groupBy("doc_id").agg(F.min("copied").alias("all_copied")).where("all_copied")
    copies = small(one.select("doc_id"), BROADCAST_ROWS)
    fresh = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").join(copies, "doc_id", "left_anti")

    spots = anchored(fresh, window)
    # written, so that the join below shuffles both sides and a hot anchor's rows may be split
    shared = stored(spots.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("h"))
    found = stored(spots.join(shared, "h").groupBy("doc_id").agg(
        F.collect_list(F.struct("h", "seq", "start", "n")).alias("spots")))
    holders = small(found.select("doc_id"), BROADCAST_ROWS)
    held = fresh.join(holders, "doc_id", "left_semi").join(found, "doc_id")
    pieces = stored(segments(held, window))
    forget(shared, found)
    distinct = stored(pieces.groupBy("h", "c").agg(F.min("doc_id").alias("doc_id"), F.first("words").alias("words")))
    firsts = stored(first_documents(distinct, window).where(F.size("firsts") > 0))
    places = F.filter(F.transform("firsts", lambda x, i: F.when(x < F.col("doc_id"), i)), lambda i: i.isNotNull())
    ranges = stored(
        pieces.select("h", "c", "doc_id", "seq", "start").join(firsts, ["h", "c"])
        .select("doc_id", "seq", "start", places.alias("places")).where(F.size("places") > 0)
        .groupBy("doc_id").agg(F.collect_list(F.struct("seq", "start", "places")).alias("ranges")))
    forget(pieces, distinct, firsts)
    losers = small(ranges.select("doc_id"), BROADCAST_ROWS)
    cut = fresh.join(losers, "doc_id", "left_semi").join(ranges, "doc_id")
    return whole, without(cut, window)


def substring_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row.

    A word goes if a window of ``window`` words covers it whose sequence also starts in a document with a
    smaller id. Whole copies are settled by the hash of their words. Of the others, windows are filed
    under anchors; anchors of several documents are the shards of the reference, and a suffix automaton
    of each gives the smallest document of every window that streams through it.

    Null and empty texts have no words; texts shorter than a window lose nothing; rows that share an id are
    one document and take nothing from each other; a row with a null id is neither compared nor changed;
    other columns are not read; no rows give no rows.
    """
    whole, cut = repeated_windows(docs, window, id_col, text_col)
    some = cut.groupBy("doc_id", "seq").agg(F.max("n_removed").alias("n_removed"), F.max("sha").alias("cut_sha"))
    nothing = hashlib.sha256(b"").hexdigest()
    return whole.join(some, ["doc_id", "seq"], "left").select(
        "doc_id", "n_words",
        F.when(F.col("copied"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("copied"), F.lit(nothing)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))
