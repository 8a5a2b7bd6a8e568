"""Near-duplicate documents: minima of universal hashes in bands, verified signatures, verified sets, components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.text import bounded_batches, hash_words, in_batches, mix, shingle_set, small, utf8
from tickloom.plans.scratch import stored

WORDS = 5
#: Bands and minima in each: a pair at similarity 0.85 shares a band with probability 1 - 8e-7, at 0.8 with 0.9999.
BANDS, ROWS = 24, 5
MINIMA = BANDS * ROWS
#: Linked documents share this share of the union of their sets, in percent, if not said otherwise; the least the bands are for.
PERCENT, LEAST_PERCENT = 85, 80
#: Members of a block of an unresolved bucket that are compared with each other.
BLOCK = 512
BROADCAST_ROWS = 1_000_000

_random = np.random.default_rng(987654321)
_A = _random.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 2**63, MINIMA, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a set, 32 bits each."""
    out = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        np.minimum(out, (part[None, :] * _A[:, None] + _B[:, None]).min(axis=1), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def bands(sig: np.ndarray) -> list[int]:
    """One 64-bit key of each band; the band's number is part of it."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return band_keys(rows).view(np.int64).tolist()


def band_keys(rows: np.ndarray) -> np.ndarray:
    total = mix(np.arange(1, len(rows) + 1, dtype=np.uint64))
    for j in range(rows.shape[1]):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + rows[:, j])
    return total


def sets_of(texts: list, words: int = WORDS) -> Iterator[np.ndarray]:
    """The shingle set of each text, A-Z folded."""
    for _, part in in_batches(utf8(texts, lower=True)):
        hashes, at = hash_words(part)
        for i in range(len(part)):
            yield shingle_set(hashes[at[i] : at[i + 1]], words)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def signed_share(percent: int) -> float:
    """Share of equal minima, 5 deviations below ``percent``, under which a pair isn't read again: 0.68 for 85, 0.61 for 80."""
    p = percent / 100
    return math.floor(100 * (p - 5 * math.sqrt(p * (1 - p) / MINIMA))) / 100


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a digest of the set (null if empty) and the signature of every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sizes, keys, sigs = [], [], []
                for s in sets_of(part.column(1).to_pylist()):
                    sizes.append(len(s))
                    keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sigs.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "key", "sig"])

    return docs.mapInArrow(sign, "doc_id bigint, n_shingles bigint, key binary, sig binary")


def banded(reps: DataFrame) -> DataFrame:
    """band, rep: a row for each band of each document."""
    @F.pandas_udf("array<bigint>")
    def keys(sigs: pd.Series) -> pd.Series:
        return sigs.map(lambda s: bands(np.frombuffer(s, dtype=np.uint32)))

    return reps.select("rep", F.explode(keys("sig")).alias("band"))


def agreeing(pairs: DataFrame, reps: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose sizes and signatures allow a link."""
    @F.pandas_udf("double")
    def share(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([float((np.frombuffer(p, np.uint32) == np.frombuffer(q, np.uint32)).mean())
                          for p, q in zip(x, y, strict=True)], dtype=float)

    left = reps.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    right = reps.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    sized = pairs.join(left, "a").join(right, "b").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    return sized.where(share("sig_a", "sig_b") >= signed_share(percent)).select("a", "b")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that are links by their full sets."""
    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        text, known = None, np.zeros(0)
        for frame in frames:
            keep = []
            for x, y in zip(frame["text_a"], frame["text_b"], strict=True):
                if x != text:
                    text, known = x, next(sets_of([x]))
                keep.append(linked(known, next(sets_of([y])), percent))
            yield frame.loc[keep, ["a", "b"]]

    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInPandas(
        check, "a bigint, b bigint")


def across(buckets: DataFrame, reps: DataFrame, texts: DataFrame, known: DataFrame,
           percent: int = PERCENT) -> DataFrame:
    """Links between different components in one bucket, as a spanning forest of each pair of blocks.

    Only buckets that hold more than one component come here. Their members are dealt to blocks of bounded
    size, and each pair of blocks is compared in a task of its own: by size, by signature, then by full sets.
    A pair is compared in its first common band alone, and not if links found in the task already join it.
    """
    comp = buckets.join(known, F.col("rep") == F.col("node"), "left").select(
        "band", "rep", F.coalesce("component", "rep").alias("comp"))
    open_ = comp.groupBy("band").agg(
        F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = comp.join(open_.select("band", blocks.alias("blocks")), "band").withColumn(
        "block", F.pmod(F.xxhash64("rep", "band"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = dealt.select("band", "rep", "comp", "block", other.alias("with")).select(
        "band", "rep", "comp", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
        (F.col("block") <= F.col("with")).alias("left"))
    full = paired.join(reps.select("rep", "n_shingles", "sig"), "rep").join(texts, "rep")
    least = signed_share(percent)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        band, i, j = int(group["band"].iloc[0]), int(group["i"].iloc[0]), int(group["j"].iloc[0])
        rep, comp, left = group["rep"].to_numpy(), group["comp"].to_numpy(), group["left"].to_numpy()
        size = group["n_shingles"].to_numpy()
        sig = np.stack([np.frombuffer(s, dtype=np.uint32) for s in group["sig"]])
        keys = np.stack([np.array(bands(s), dtype=np.int64) for s in sig])
        texts_, sets = group["text"].tolist(), {}
        root = {int(c): int(c) for c in comp}

        def top(c: int) -> int:
            while root[c] != c:
                root[c] = c = root[root[c]]
            return c

        found = []
        for x in np.flatnonzero(left):
            rest = np.flatnonzero((comp != comp[x]) & ((rep > rep[x]) if i == j else ~left))
            rest = rest[(100 * np.minimum(size[rest], size[x]) >= percent * np.maximum(size[rest], size[x]))]
            rest = rest[(sig[rest] == sig[x]).mean(axis=1) >= least]
            for y in rest:
                if keys[x][(keys[x] == keys[y]).argmax()] != band or top(int(comp[x])) == top(int(comp[y])):
                    continue
                for z in (x, y):
                    if z not in sets:
                        sets[z] = next(sets_of([texts_[z]]))
                if linked(sets[x], sets[y], percent):
                    root[top(int(comp[x]))] = top(int(comp[y]))
                    found.append((int(rep[x]), int(rep[y])))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return full.groupBy("band", "i", "j").applyInPandas(compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Equal sets are one node from the start, however many rows have them. Nodes that share a band with
    another are linked to the smallest of the bucket if sizes, signatures and full sets agree; buckets that then
    still hold several components are compared in blocks, so no link is lost and no group is
    expanded into pairs. Components follow by alternating stars.

    Null and empty texts have no set, and no links; rows that share an id are one document, linked to what
    any of them is linked to; a row with a null id has no component and is kept; other columns are not
    read; no rows give no rows. ``percent`` of the union is shared by a link; below LEAST_PERCENT the bands
    would miss pairs.
    """
    if not LEAST_PERCENT <= percent <= 100:
        raise ValueError(f"percent must be from {LEAST_PERCENT} to 100")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    bounded_batches(docs.sparkSession)
    sets = stored(signed(rows))
    real = sets.where(F.col("key").isNotNull() & F.col("doc_id").isNotNull())
    chosen = real.groupBy("key").agg(F.min(F.struct("doc_id", "n_shingles", "sig")).alias("m"))
    reps = stored(chosen.select("key", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("n_shingles"),
                                F.col("m.sig").alias("sig")))
    member = sets.select("doc_id", "n_shingles", "key").join(reps.select("key", "rep"), "key", "left")
    member = stored(member.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep")))
    several = member.where(F.col("rep").isNotNull()).groupBy("doc_id").agg(
        F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z")
    same_id = member.join(several, "doc_id").select("a", F.col("rep").alias("b"))

    every = stored(banded(reps))
    shared = every.groupBy("band").agg(F.count("*").alias("n"), F.min("rep").alias("a")).where("n > 1")
    buckets = stored(every.join(shared.select("band", "a"), "band").select("band", "rep", "a"))
    needed = small(buckets.select("rep").distinct(), BROADCAST_ROWS)
    chosen_text = rows.join(needed, rows["doc_id"] == F.col("rep"), "left_semi")
    texts = stored(distinct_texts(chosen_text, member))
    pairs = buckets.where("rep != a").select("a", F.col("rep").alias("b")).distinct()
    stars = stored(confirmed(agreeing(pairs, reps, percent), texts, percent))
    known = components(stars)
    more = across(buckets.select("band", "rep"), reps, texts, known, percent)
    links = stars.union(more).union(same_id)
    final = components(links)
    joined = member.join(final, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def distinct_texts(rows: DataFrame, member: DataFrame) -> DataFrame:
    """rep, text of every row; rows that share their id are made distinct, all others aren't shuffled."""
    texts = rows.select(F.col("doc_id").alias("rep"), "text").where(F.col("text").isNotNull())
    twice = small(member.groupBy(F.col("doc_id").alias("rep")).count().where("count > 1").select("rep"), BROADCAST_ROWS)
    again = texts.join(twice, "rep", "left_semi").dropDuplicates()
    return texts.join(twice, "rep", "left_anti").union(again)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   percent: int = PERCENT) -> DataFrame:
    """One row of each group of near-duplicates: that of the smallest id, any one of rows that share it.

    Rows without words or with a null id are in no group and stay.
    """
    found = stored(near_duplicates(docs, id_col, text_col, percent))
    gone = small(found.where(~F.col("kept")).select(F.col("doc_id").alias("t_gone")).distinct(), BROADCAST_ROWS)
    left = docs.join(gone, docs[id_col] == F.col("t_gone"), "left_anti")
    twice = found.where("kept AND doc_id IS NOT NULL AND n_shingles > 0").groupBy(F.col("doc_id").alias("t_id")).count().where("count > 1")
    twice = small(twice.select("t_id"), BROADCAST_ROWS)
    again = left.join(twice, left[id_col] == F.col("t_id"), "left_semi").dropDuplicates([id_col])
    return left.join(twice, left[id_col] == F.col("t_id"), "left_anti").union(again)
