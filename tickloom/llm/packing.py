"""Packing of documents into sequences of one length by non-negative least squares over a length histogram."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickloom.llm.merging import Pairs
from tickloom.llm.text import bounded_batches
from tickloom.plans.scratch import stored

#: Lengths are counted in units of so many tokens: 64 units fill a sequence of 4096.
UNITS = 64
#: A combination has at most so many lengths.
PARTS = 4
#: Distinct words a worker remembers across its tasks; the memory is emptied beyond it.
REMEMBERED = 250_000
#: Sequence ids: those closed inside a task are task * 2**32 + n; shared ones start here.
SHARED = 1 << 60
#: White space that every such tokenizer drops; a word may hold other white space.
_WORDS = re.compile(r"[^\x20\t\n\r]+")
#: Texts whose case, composition and classes of characters leave no doubt: ASCII and the letters of Latin-1.
_PLAIN = re.compile(r"[\x20-\x7E\t\n\r\xC0-\xD6\xD8-\xF6\xF8-\xFF]*")
#: How such a tokenizer splits a text in lower case.
_PRETOKENS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xDF-\xF6\xF8-\xFF]+|[0-9]|[^\x20\t\n\ra-z0-9\xDF-\xF6\xF8-\xFF]+")
#: Longer pre-tokens are left to the tokenizer, and are not remembered: so memory is bounded in bytes, too.
LONG = 64

_COLUMNS = T.StructType([
    T.StructField("task", T.IntegerType()), T.StructField("bin", T.IntegerType()),
    T.StructField("rank", T.LongType()), T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("halves", T.ArrayType(T.LongType())),
])


class WordIds:
    """Token ids of texts as the tokenizer gives them, for vocabularies that drop white space and end words.

    Texts of ASCII and Latin-1 letters are split and merged here, distinct words together and once; the words of
    other texts, and words that are long or hold a special token, are encoded by the tokenizer itself.
    """

    def __init__(self, path: str, end: int):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.end = np.array([end], dtype="<u4").tobytes()
        self.known: dict[str, bytes] = {}
        self.whole: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = {c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in map(chr, range(128))}
        self.inner = np.array([vocab[letters[chr(c)]] if c < 128 else -1 for c in range(256)])
        self.last = np.array([vocab[letters[chr(c)] + suffix] if c < 128 else -1 for c in range(256)])
        high = {c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}
        for c, shown in high.items():
            for byte, mark in zip(c.encode(), shown, strict=True):
                self.inner[byte], self.last[byte] = vocab[mark], vocab[mark + suffix]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.pairs = Pairs(((vocab[a], vocab[b], r, vocab[a + b]) for r, (a, b) in enumerate(merges)), len(vocab))

    def learn(self, words: list[str]) -> None:
        """Merge words (lower case, of the plain alphabet) together."""
        long = [w for w in words if len(w) > LONG]
        for word, got in zip(long, self.tokenizer.encode_batch_fast(long, add_special_tokens=False), strict=True):
            self.known[word] = np.array(got.ids, dtype="<u4").tobytes()
        short = [w for w in words if len(w) <= LONG]
        raw = [w.encode() for w in short]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sym = self.inner[flat]
        final = np.cumsum(sizes) - 1
        sym[final] = self.last[flat[final]]
        ids, owner = self.pairs.merge(sym, np.repeat(np.arange(len(raw)), sizes))
        data = ids.astype("<u4").tobytes()
        ends = (np.cumsum(np.bincount(owner, minlength=len(raw))) * 4).tolist()
        start = 0
        for word, stop in zip(short, ends, strict=True):
            self.known[word] = data[start:stop]
            start = stop

    def foreign(self, words: list[str]) -> None:
        """Encode white-space separated words by the tokenizer."""
        for word, got in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.whole[word] = np.array(got.ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, the closing id included."""
        parts = []
        for t in texts:
            t = t or ""
            plain = _PLAIN.fullmatch(t) and "<|" not in t
            parts.append((self.known, _PRETOKENS.findall(t.lower())) if plain else (self.whole, _WORDS.findall(t)))
        long = []
        for known, learn in ((self.known, self.learn), (self.whole, self.foreign)):
            used = [words for k, words in parts if k is known]
            fresh = list({w for words in used for w in words if w not in known})
            if len(known) + len(fresh) > REMEMBERED:
                known.clear()
                fresh = list({w for words in used for w in words})
            for i in range(0, len(fresh), 50_000):
                learn(fresh[i : i + 50_000])
            long += [(known, w) for w in fresh if len(w) > LONG]
        ids = [b"".join(map(known.__getitem__, words)) + self.end for known, words in parts]
        for known, word in long:
            del known[word]
        return ids


_loaded: dict[tuple[str, int], WordIds] = {}


def word_ids(path: str, end: int) -> WordIds:
    """The encoder of a tokenizer file, read once in each worker."""
    if (path, end) not in _loaded:
        _loaded[path, end] = WordIds(path, end)
    return _loaded[path, end]


def powers_of(units: int) -> list[int]:
    """Powers of two that make up a number, largest first."""
    return [1 << b for b in reversed(range(units.bit_length())) if units >> b & 1]


class Pieces:
    """Cuts one task's documents: whole sequences, tails joined in this task, remainders left to the plan."""

    def __init__(self, task: int, size: int):
        self.task, self.size, self.unit = task, size, size // UNITS
        self.local = 0
        self.ranks = [0] * UNITS
        self.open: list[list] = []
        self.filled = 0

    def sequence(self) -> int:
        self.local += 1
        return (self.task << 32) + self.local

    def cut(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // 4
        at = 0
        while total - at >= self.size:
            yield self.row(doc, ids, at, self.size, total, self.sequence(), 0)
            at += self.size
        if units := (total - at) // self.unit:
            length = units * self.unit
            halves, begin = [], at
            for p in powers_of(units):
                halves.append(zlib.crc32(ids[4 * begin : 4 * (begin + p * self.unit)]))
                begin += p * self.unit
            row = self.row(doc, ids, at, length, total, None, None)
            yield (self.task, units, self.ranks[units], *row[3:10], halves)
            self.ranks[units] += 1
            at += length
        while at < total:
            take = min(total - at, self.size - self.filled)
            self.open.append([doc, ids[4 * at : 4 * (at + take)], at, take, total])
            self.filled += take
            at += take
            if self.filled == self.size:
                yield from self.close(self.size)

    def row(self, doc, ids, at, length, total, sequence, offset) -> tuple:
        crc = zlib.crc32(ids[4 * at : 4 * (at + length)])
        return (self.task, 0, 0, doc, at, length, crc, total, sequence, offset, None)

    def close(self, length: int) -> Iterator[tuple]:
        """The first ``length`` open tokens become a sequence."""
        sequence, offset = self.sequence(), 0
        while offset < length:
            doc, ids, at, take, total = self.open[0]
            use = min(take, length - offset)
            yield (self.task, 0, 0, doc, at, use, zlib.crc32(ids[: 4 * use]), total, sequence, offset, None)
            if use == take:
                self.open.pop(0)
            else:
                self.open[0] = [doc, ids[4 * use :], at + use, take - use, total]
            offset += use
        self.filled -= length

    def finish(self) -> Iterator[tuple]:
        """What is left open becomes sequences of powers of two, which need no padding."""
        for length in powers_of(self.filled):
            yield from self.close(length)


def combinations(units: int, parts: int, least: int = 1) -> list[tuple[int, ...]]:
    """All ways to fill a sequence with two to ``parts`` lengths, each in rising order."""
    def fill(left: int, low: int, n: int) -> list[tuple[int, ...]]:
        if n == 1:
            return [(left,)] if left >= low else []
        return [(a, *rest) for a in range(low, left // n + 1) for rest in fill(left - a, a, n - 1)]

    return [c for n in range(2, parts + 1) for c in fill(units, least, n)]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """Least ||a x - b|| over x >= 0, by the active-set method."""
    x = np.zeros(a.shape[1])
    used = np.zeros(a.shape[1], dtype=bool)
    gradient = a.T @ (b - a @ x)
    tiny = 1e-9 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(rounds):
        free = np.where(used, -np.inf, gradient)
        j = int(free.argmax())
        if free[j] <= tiny:
            break
        used[j] = True
        while True:
            trial = np.zeros_like(x)
            trial[used] = np.linalg.lstsq(a[:, used], b, rcond=None)[0]
            if trial[used].min(initial=0) > -tiny:
                x = np.maximum(trial, 0)
                break
            low = used & (trial <= 0)
            step = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + step * (trial - x)
            used &= x > tiny
            x[~used] = 0
        gradient = a.T @ (b - a @ x)
    return x


def repeat_counts(histogram: np.ndarray, parts: int = PARTS) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """How often each combination is filled, and how many of each length remain.

    The histogram is solved for, the solution rounded down, and what that leaves over is packed greedily,
    the longest lengths first.
    """
    units = len(histogram)
    shapes = combinations(units, parts)
    a = np.zeros((units, len(shapes)))
    for j, shape in enumerate(shapes):
        for u in shape:
            a[u, j] += 1
    left = histogram.astype(np.int64).copy()
    filled: dict[tuple[int, ...], int] = {}

    def use(j: int, most: int) -> None:
        need = a[:, j].astype(np.int64)
        n = min(most, int((left[need > 0] // need[need > 0]).min()))
        if n > 0:
            left[:] -= n * need
            filled[shapes[j]] = filled.get(shapes[j], 0) + n

    if left.sum():
        x = nnls(a, histogram.astype(float))
        for j in np.argsort(-x, kind="stable"):
            if x[j] >= 1:
                use(int(j), int(x[j] + 1e-6))
        for j in sorted(range(len(shapes)), key=lambda j: (-max(shapes[j]), len(shapes[j]), shapes[j])):
            use(j, int(left.sum()))
    return sorted(filled.items()), left


def slots(filled: list[tuple[tuple[int, ...], int]], histogram: np.ndarray, left: np.ndarray,
          unit: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Where the items of each length go: (bin, first rank, end rank, first sequence, group, offset, part).

    Items ``first .. end`` go to sequences ``first sequence + (rank - first) // group`` with a step of one;
    ``part`` is -1 for a whole item, else the place of one of its powers of two.
    """
    taken = np.zeros(len(histogram), dtype=np.int64)
    rows, sequence = [], SHARED
    for shape, n in filled:
        offset = 0
        for u in sorted(shape, reverse=True):
            rows.append((u, int(taken[u]), int(taken[u] + n), sequence, 1, offset * unit, -1))
            taken[u] += n
            offset += u
        sequence += n
    # the rest: a length is cut into powers of two, and those of one size fill sequences of their own
    full = len(histogram)
    for p in powers_of(full - 1):
        count = full // p
        total = sum(int(left[u]) for u in range(full) if u & p)
        whole = total // count * count
        index = 0
        for u in range(full):
            if u & p and left[u]:
                # (rank - lo + index) picks the sequence; those past the last whole one stand alone
                rows.append((u, int(taken[u] - index), int(taken[u] + left[u]), sequence, count, whole,
                             powers_of(u).index(p)))
                index += int(left[u])
        sequence += whole // count + (total - whole)
    return rows


def cut_documents(docs: DataFrame, tokenizer: str, size: int, end: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``_COLUMNS``: sequences closed inside a task have their id, remainders bin and rank."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = word_ids(tokenizer, end)
        pieces = Pieces(TaskContext.get().partitionId(), size)
        schema = pa.schema([("task", pa.int32()), ("bin", pa.int32()), ("rank", pa.int64()), ("doc_id", pa.int64()),
                            ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                            ("halves", pa.list_(pa.int64()))])

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)],
                                              schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                texts = part.column(1).to_pylist()
                for doc, ids in zip(part.column(0).to_pylist(), words.encode(texts), strict=True):
                    rows.extend(pieces.cut(doc, ids))
                if rows:
                    yield batch_of(rows)
        if rows := list(pieces.finish()):
            yield batch_of(rows)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, _COLUMNS)


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, end: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pieces of all documents in sequences of ``size`` tokens: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A document's ids and the ``end`` id are cut into whole sequences, a remainder in units of
    ``size / 64`` tokens, and a tail shorter than a unit. Tails are joined inside their task. Remainders
    are packed by a plan: combinations of up to four lengths that fill a sequence are enumerated, their
    repeat counts solved against the histogram of 63 lengths, rounded down, and the rest packed greedily,
    lastly in powers of two. No sequence needs padding: each has ``size`` tokens or a power of two.

    Only the histogram reaches the driver. Which item of a length goes where follows from its rank,
    which is a count inside its task plus the counts of the tasks before. Null and empty texts are the
    ``end`` id alone; null ids stay null; repeated rows are packed each; other columns are not read; no
    rows give no sequences.
    """
    if size % UNITS or size & (size - 1):
        raise ValueError(f"size must be a power of two and a multiple of {UNITS}, not {size}")
    bounded_batches(docs.sparkSession)
    pieces = stored(cut_documents(docs, tokenizer, size, end, id_col, text_col))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    closed = pieces.where(F.col("bin") == 0).select(*columns)

    counts = stored(pieces.where(F.col("bin") > 0).groupBy("bin", "task").agg(F.count("*").alias("n")))
    histogram = np.zeros(UNITS, dtype=np.int64)
    for row in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # 63 rows at most
        histogram[row["bin"]] = row["n"]
    filled, left = repeat_counts(histogram)
    plan = slot_table(docs.sparkSession, slots(filled, histogram, left, size // UNITS))
    before = Window.partitionBy("bin").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("bin", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    unit = size // UNITS
    k = F.col("g") - F.col("lo")
    part, u = F.col("part"), F.col("bin")
    ranked = (
        pieces.where(F.col("bin") > 0)
        .join(bases, ["bin", "task"])
        .withColumn("g", F.col("rank") + F.col("base"))
        .join(F.broadcast(plan), "bin")  # at most a few hundred rows, from a histogram of 63 lengths
        .where((F.col("g") >= F.col("real_lo")) & (F.col("g") < F.col("hi")))
    )
    # units of an item before its part, and units of the part itself
    ahead, width = F.col("ahead"), F.col("width")
    grouped = k < F.col("whole")
    shared = ranked.select(
        "doc_id",
        (F.col("start") + F.when(part < 0, 0).otherwise(ahead * unit)).alias("start"),
        F.when(part < 0, F.col("length")).otherwise(width * unit).alias("length"),
        F.when(part < 0, F.col("ids_crc32")).otherwise(F.get(F.col("halves"), part)).alias("ids_crc32"),
        "doc_tokens",
        F.when(part < 0, F.col("seq") + k)
        .when(grouped, F.col("seq") + F.floor(k / F.col("group")))
        .otherwise(F.col("seq") + F.floor(F.col("whole") / F.col("group")) + k - F.col("whole")).alias("sequence_id"),
        F.when(part < 0, F.col("offset_in")).when(grouped, (k % F.col("group")) * width * unit).otherwise(0)
        .cast("bigint").alias("offset"),
    )
    return closed.unionByName(shared)


def slot_table(spark: SparkSession, rows: list[tuple[int, int, int, int, int, int, int]]) -> DataFrame:
    """The slots as a table; ``lo`` counts ranks from, ``real_lo`` is the first rank that is there."""
    out, first = [], {}
    for u, lo, hi, seq, group, extra, part in rows:
        if part < 0:
            out.append((u, lo, lo, hi, seq, group, extra, 0, part, 0, u))
            first[u] = max(first.get(u, 0), hi)
        else:
            p = powers_of(u)
            out.append((u, lo, first.get(u, 0), hi, seq, group, 0, extra, part, sum(p[:part]), p[part]))
    return spark.createDataFrame(
        out, "bin int, lo bigint, real_lo bigint, hi bigint, seq bigint, group bigint, offset_in bigint, "
             "whole bigint, part int, ahead int, width int")

