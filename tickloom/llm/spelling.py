"""Spelling variants: pivotal bigrams propose words one edit apart, which are verified and lead to their commonest form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.text import bounded_batches, fold, mix, stretch_hashes, text_of
from tickloom.plans.scratch import forget, stored

#: The letters of a word.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: Edits that are looked for. Of so many bigrams and one more that do not overlap, one outlives the edits.
EDITS = 1
PIVOTS = EDITS + 1
#: Rarest bigrams of a word that hold pivots: two that overlap and one more.
PREFIX = 2 * EDITS + 1
#: Bigrams are counted and ordered by a hash of this many values, whatever the alphabet.
BUCKETS = 1 << 16
#: Words of fewer letters have no two bigrams among PREFIX that do not overlap.
SHORTEST = 4

#: Rows of words up to this length carry the word, those of longer ones a hash of it.
LONG = 64
#: Letters that are worked on at once.
SLICE = 1 << 20


def letter_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, run: a row for each maximal run of letters of each text, A-Z folded."""
    found = F.regexp_extract_all(fold(text_of(text_col)), F.lit(LETTERS), F.lit(0))
    return docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("run"))


def vocabulary(words: Column, rows: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that are long and frequent enough; counts are summed in each task before they are shuffled."""
    long = rows.select(words.alias("word")).where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


class Letters:
    """The words of a batch as one array of code points."""

    def __init__(self, words: list[str]) -> None:
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)[:-1])).astype(np.int64)
        self.hashes = mix(points.astype(np.uint64) + np.uint64(1))
        n_grams = np.maximum(self.sizes - 1, 0)
        #: Of each bigram: its word, its place there, its bucket.
        self.word = np.repeat(np.arange(len(words)), n_grams)
        self.place = np.arange(len(self.word)) - np.repeat(np.cumsum(n_grams) - n_grams, n_grams)
        at = self.starts[self.word] + self.place
        pair = points[at].astype(np.uint64) << np.uint64(32) | points[at + 1] if len(at) else np.zeros(0, np.uint64)
        self.bucket = (mix(pair) % np.uint64(BUCKETS)).astype(np.int64)

    def stretch(self, word: np.ndarray, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of the letters ``first .. stop`` of each word."""
        return stretch_hashes(self.hashes, self.starts[word] + first, self.starts[word] + stop).view(np.uint64)


def bigram_counts(vocab: DataFrame) -> np.ndarray:
    """How many bigrams of the distinct words are in each bucket; BUCKETS numbers, whatever the table."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            total += np.bincount(Letters(batch.column(0).to_pylist()).bucket, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "c"])

    rows = vocab.select("word").mapInArrow(count, "bucket bigint, c bigint").groupBy("bucket").agg(F.sum("c").alias("c"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.collect():
        out[r["bucket"]] = r["c"]
    return out


def disjoint(places: list[int], weights: list[int], count: int = PIVOTS) -> tuple[int, ...]:
    """Indices of ``count`` bigrams of least total weight that do not overlap; ``places`` rise."""
    best: list[tuple[float, tuple[int, ...]]] = [(0, ())] * (len(places) + 1)
    for _ in range(count):
        longer: list[tuple[float, tuple[int, ...]]] = [(float("inf"), ())]
        for i, (p, w) in enumerate(zip(places, weights, strict=True)):
            weight, chosen = best[i - 1 if i and places[i - 1] == p - 1 else i]
            longer.append(min(longer[-1], (weight + w, (*chosen, i))))
        best = longer
    return best[-1][1]


def prefixes(letters: Letters, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bigrams of each word's prefix, in their order, and the highest rank in each word's prefix.

    A prefix holds the PREFIX rarest bigrams and all others of its last one's rank.
    """
    rank = ranks[letters.bucket]
    order = np.lexsort((letters.place, rank, letters.word))
    first = np.searchsorted(letters.word, np.arange(len(letters.sizes)))
    last = np.zeros(len(letters.sizes), dtype=np.int64)
    enough = letters.sizes >= SHORTEST
    last[enough] = rank[order[first[enough] + PREFIX - 1]]
    return np.flatnonzero((rank <= last[letters.word]) & enough[letters.word]), last


def context_keys(letters: Letters, word: np.ndarray, place: np.ndarray, right: bool,
                 other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of words around a bigram, and the row each is of.

    With the edit to the right of the bigram, the letters up to the bigram's end are alike and so is one half of the
    rest, its first ``half`` letters or its last: ``other`` is the length of the rest in the word that is looked up. With the edit
    to the left it is the other way round.
    """
    size = letters.sizes[word]
    half = np.maximum(other - 1, 0) // 2
    if right:
        known = letters.stretch(word, np.zeros_like(place), place + 2)
        halves = ((place + 2, place + 2 + half), (size - half, size))
    else:
        known = letters.stretch(word, place, size)
        halves = ((np.zeros_like(place), half), (place - half, place))
    base = mix(known + other.astype(np.uint64) * np.uint64(4) + np.uint64(2 * right))
    rows = np.arange(len(word))
    keys, of = [], []
    for k, (first, stop) in enumerate(halves):
        use = rows if k == 0 else rows[half > 0]
        keys.append(mix(base[use] + mix(letters.stretch(word[use], first[use], stop[use]) + np.uint64(k))))
        of.append(use)
    return np.concatenate(keys), np.concatenate(of)


def indexed(letters: Letters, ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of every bigram of every prefix, the word of each, and the words' highest ranks."""
    inside, last = prefixes(letters, ranks)
    word, place = letters.word[inside], letters.place[inside]
    keys, of = [], []
    for right in (True, False):
        rest = letters.sizes[word] - place - 2 if right else place
        k, rows = context_keys(letters, word, place, right, rest)
        keys.append(k)
        of.append(word[rows])
    return np.concatenate(keys), np.concatenate(of), last


def probing(letters: Letters, ranks: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word's two pivots, for a rest as long as its own, one shorter and one longer.

    An edit behind the first pivot leaves all up to the pivot's end; any other lies before the second
    pivot and leaves all from there. So the first is looked up with the edit to its right alone, the second to its left.
    """
    inside, last = prefixes(letters, ranks)
    word = letters.word[inside]
    place, weight = letters.place[inside], counts[letters.bucket[inside]]
    cuts = np.searchsorted(word, np.arange(len(letters.sizes) + 1))
    owners = np.flatnonzero(np.diff(cuts))
    places, weights = place.tolist(), weight.tolist()
    chosen = np.array([[places[cuts[w] + i] for i in disjoint(places[cuts[w]:cuts[w + 1]], weights[cuts[w]:cuts[w + 1]])]
                       for w in owners.tolist()], dtype=np.int64).reshape(-1, PIVOTS)
    keys, of = [], []
    for right in (True, False):
        at = chosen[:, 0 if right else 1]
        rest = letters.sizes[owners] - at - 2 if right else at
        for change in range(-EDITS, EDITS + 1):
            use = np.flatnonzero(rest + change >= 0)
            k, rows = context_keys(letters, owners[use], at[use], right, (rest + change)[use])
            keys.append(k)
            of.append(owners[use][rows])
    return np.concatenate(keys), np.concatenate(of), last


def keyed(words: DataFrame, make, counts: np.ndarray) -> DataFrame:
    """key, rank and the other columns of ``words``, in the rows that ``make`` gives for the words of each batch."""
    ranks = np.empty(BUCKETS, dtype=np.int64)
    ranks[np.argsort(counts, kind="stable")] = np.arange(BUCKETS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            size = np.cumsum([len(t) for t in texts]) // SLICE
            cuts = np.searchsorted(size, np.arange(size[-1] + 2)) if len(texts) else [0]
            for at, stop in zip(cuts[:-1], cuts[1:], strict=True):
                if at == stop:
                    continue
                keys, of, last = make(Letters(texts[at:stop]), ranks, counts)
                take = pa.array(of + at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(last[of].astype(np.int32)),
                     *(c.take(take) for c in batch.columns[1:])], names=["key", "rank", *batch.schema.names[1:]])

    carried = ", ".join(f"{c} {kind}" for c, kind in words.dtypes[1:])
    return words.mapInArrow(rows, f"key bigint, rank int, {carried}")


def candidates(words: DataFrame, counts: np.ndarray, near: Column) -> DataFrame:
    """Rows (word, n, other, n_other) of ``words`` (letters, word, n) whose pivots and prefixes meet and that are ``near``."""
    probe = keyed(words, probing, counts)
    index = keyed(words, indexed, counts).toDF("key", "rank_other", "other", "n_other")
    met = (probe["key"] == index["key"]) & (F.col("rank") <= F.col("rank_other")) & (F.col("word") != F.col("other"))
    return probe.join(index, met & near).select("word", "n", "other", "n_other")


def near_words(vocab: DataFrame) -> DataFrame:
    """a, n_a, b, n_b: each pair of words that differ by one inserted, deleted or replaced letter, once, a < b.

    Bigrams are ordered by how many words hold them. Of a near pair, let the first be the word whose prefix ends
    earlier in that order: one of its pivots outlives the edit, so it stands in the other word's
    prefix, moved by one letter at most. Pivots are looked up among the prefixes by an equality join whose key holds the bigram's
    position, the letters beyond it on the side without the edit, the length of the rest and half of its letters,
    so no list of all words with a common bigram is met. The distance of all found pairs is computed. Words of LONG
    letters and more meet by their hashes and are joined to their letters after that.
    """
    counts = bigram_counts(vocab)
    apart = F.levenshtein("word", "other", EDITS) == 1
    short = candidates(vocab.where(F.length("word") <= LONG).select(F.col("word").alias("letters"), "word", "n"), counts, apart)
    long = vocab.where(F.length("word") >= LONG).select("word", "n", F.xxhash64("word").alias("id"))
    met = candidates(long.select(F.col("word").alias("letters"), F.col("id").alias("word"), "n"), counts, F.lit(True))
    met = met.select(F.col("word").alias("id"), F.col("other").alias("id_other")).distinct()
    others = long.select(F.col("word").alias("other"), F.col("n").alias("n_other"), F.col("id").alias("id_other"))
    found = short.union(met.join(long, "id").join(others, "id_other").where(apart).select("word", "n", "other", "n_other"))
    one, two = F.struct("word", "n"), F.struct(F.col("other").alias("word"), F.col("n_other").alias("n"))
    pair = found.select(F.least(one, two).alias("x"), F.greatest(one, two).alias("y"))
    return pair.select(F.col("x.word").alias("a"), F.col("x.n").alias("n_a"), F.col("y.word").alias("b"),
                       F.col("y.n").alias("n_b")).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words that have a form: the end of their chain of forms, by doubling.

    Each step at least doubles the count of the word, so chains are short and rounds few; each round is a written table.
    """
    at = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = stored(at.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        forget(at)
        at = after
        if not at.where("moved").limit(1).count():
            return at.select("word", "root")


def spelling_variants(vocab: DataFrame, word_col: str = "word", n_col: str = "n", least_factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a vocabulary.

    Near words differ by exactly one inserted, deleted or replaced code point. ``form`` is the near word of largest n
    (of equal ones the first by code points) if its n is ``least_factor`` times the word's own or more, else
    null; ``root`` the end of the chain of forms, the word itself if it has none; ``n_near`` counts near words.

    Rows of one word are one, their n summed; null words are left out, null n counts 0; words of fewer than SHORTEST
    letters are near to nothing; other columns are not read; no rows give no rows. ``least_factor`` is 2 or more,
    so that chains end.
    """
    if least_factor < 2:
        raise ValueError("least_factor must be 2 or more")
    bounded_batches(vocab.sparkSession)
    rows = vocab.select(F.col(word_col).cast("string").alias("word"), F.col(n_col).cast("bigint").alias("n"))
    words = stored(rows.where(F.col("word").isNotNull()).groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    pairs = near_words(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("n_other")).union(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a")))
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(
        (-F.col("n_other")).alias("less"), F.col("other").alias("form"))).alias("best"))
    joined = words.join(near, "word", "left")
    follows = -F.col("best.less") >= least_factor * F.col("n")
    out = stored(joined.select(
        "word", F.when(follows, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, -F.col("best.less")).alias("form_n")))
    forget(words)
    ends = roots(out.where(F.col("form").isNotNull()))
    return out.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
