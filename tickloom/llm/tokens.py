"""Token counts of byte-fallback piece vocabularies, by merging pairs in ragged numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.merging import Pairs
from tickloom.llm.text import bounded_batches

SPACE = "▁"
#: Distinct pre-tokens a worker remembers; the memory is emptied beyond it.
REMEMBERED = 400_000
#: Pre-tokens of more symbols merge by a heap of their own, in n log n, and are not remembered: so memory is bounded in bytes, too.
LONG = 64

_PIECES = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class PieceMerges:
    """The merge table of a piece vocabulary: which symbols join, into what, and in which order."""

    def __init__(self, model: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        pieces = {sp.id_to_piece(i): i for i in plain}
        self.chars = np.full(0x110000, -1, dtype=np.int64)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.pairs = Pairs((
            (pieces[piece[:cut]], pieces[piece[cut:]], order[sp.get_score(i)], i)
            for piece, i in pieces.items() for cut in range(1, len(piece))
            if piece[:cut] in pieces and piece[cut:] in pieces), size)
        self.known: dict[str, int] = {}

    def symbols(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Characters of all pieces as ids (-1: not in the vocabulary), characters of each piece, and
        how many more tokens each takes for characters written as bytes."""
        points = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        flat = self.chars[points]
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        more = np.r_[0, np.cumsum(np.where(flat < 0, width - 1, 0))]
        ends = np.cumsum(counts)
        return flat, counts, more[ends] - more[ends - counts]

    def merged(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        if not pieces:
            return []
        flat, counts, extra = self.symbols(pieces)
        ends = np.cumsum(counts)
        left = counts.copy()
        for i in np.flatnonzero(counts > LONG):
            left[i] = self.pairs.count_long(flat[ends[i] - counts[i] : ends[i]].tolist())
        short = (counts <= LONG) & (counts > 1)
        rest = np.flatnonzero(short)
        owner = np.repeat(np.arange(len(rest)), counts[rest])
        left[rest] = np.bincount(self.pairs.merge(flat[np.repeat(short, counts)], owner)[1], minlength=len(rest))
        return (left + extra).tolist()

    def count(self, texts: Iterable[str | None]) -> list[int]:
        """Tokens of each text."""
        split = [_PIECES.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        fresh = list({p for parts in split for p in parts}.difference(self.known))
        if len(self.known) + len(fresh) > REMEMBERED:
            self.known.clear()
            fresh = list({p for parts in split for p in parts})
        for i in range(0, len(fresh), 50_000):
            part = fresh[i : i + 50_000]
            self.known.update(zip(part, self.merged(part), strict=True))
        get = self.known.__getitem__
        counts = [sum(map(get, parts)) for parts in split]
        for piece in fresh:
            if len(piece) > LONG:
                del self.known[piece]
        return counts


_loaded: dict[str, PieceMerges] = {}


def merges(model: str) -> PieceMerges:
    """The table of a model file, read once in each worker."""
    if model not in _loaded:
        _loaded[model] = PieceMerges(model)
    return _loaded[model]


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, in one pass without a shuffle.

    A text is split before every run of spaces, which no piece of such a vocabulary crosses;
    distinct pre-tokens merge together. Null and empty texts have no bytes and no tokens; a null id
    stays null; repeated rows are counted each; other columns are not read. ``model`` is a path that
    every worker sees.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merges(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0),
                     pa.array([len(t.encode("utf-8", "surrogatepass")) if t else 0 for t in texts], pa.int64()),
                     pa.array(table.count(texts), pa.int64())],
                    names=["doc_id", "n_bytes", "n_tokens"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.mapInArrow(counted, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
