"""Toxicity: boosted trees over dense features of whole texts, calibrated by isotonic regression."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.text import bounded_batches, small
from tickloom.plans.scratch import stored

#: Labelled rows the model is fitted on, about; more are thinned by a hash of their id, each class for itself, and weighted.
SAMPLE_ROWS = 12_000
#: Share of the sample that the rarer class may fill, if it isn't more common than that: all its rows up to 3,000 are used.
RARE_SHARE = 0.25
#: Most entries of the learned lexicon, and rows of the positive class that an entry must occur in.
LEXICON, SUPPORT = 4_000, 4
TREES, DEPTH, BINS = 20, 4, 32
#: With fewer documents of a class than this in the sample, all rows serve the lexicon, the trees and the calibration, by folds.
FEW, FOLDS = 50, 5

#: Second-person words of the four languages.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer sie ihnen tu te toi ton ta tes "
                   "vous votre vos usted ustedes tú ti tus vosotros".split())
#: Characters that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGES = ".,;:!?\"'()[]{}<>|*&%$#-_…«»“”„"
_INNER = re.compile(r"[.*_\-~^]")
_RUN = re.compile(r"(.)\1{2,}")
PREFIXES = (4, 5, 6)
NAMES = ("hits", "distinct", "density", "strongest", "strength", "disguised", "near_second", "second_rate",
         "capitals", "upper_words", "punctuation", "exclaims", "odd_rate", "runs", "mean_word", "log_words", "top_weight")
#: Words a worker remembers, of at most so many letters: longer ones are weighed anew in each text, so memory is bounded in bytes, too.
REMEMBERED, LONG = 150_000, 64


def terms(word: str) -> list[str]:
    """A word and its longer prefixes; prefixes are marked."""
    return [word, *(word[:n] + "+" for n in PREFIXES if len(word) > n)]


def plain(word: str) -> str:
    """A disguised word as it is meant."""
    return _RUN.sub(r"\1\1", _INNER.sub("", word.translate(DISGUISE)))


def is_odd(word: str) -> bool:
    """Letters mixed with digits or marks inside the word."""
    return any(c.isalpha() for c in word) and not word.replace("'", "").replace("’", "").isalpha()


@dataclass
class Features:
    """The feature vector of a text, given the lexicon's weights; words seen before are looked up."""

    lexicon: dict[str, float]
    known: dict[str, tuple[float, bool, bool, bool] | None] = field(default_factory=dict)

    def weight(self, word: str) -> tuple[float, bool, bool, bool]:
        """A word's weight; whether it took undoing a disguise, is in the second person, or hides digits."""
        bare = word.strip(EDGES)
        best, hidden = max((self.lexicon.get(t, 0.0) for t in terms(bare)), default=0.0), False
        if is_odd(bare):
            shown = max((self.lexicon.get(t, 0.0) for t in terms(plain(bare))), default=0.0)
            best, hidden = max(best, shown), shown > best
        return best, hidden, bare in SECOND, bool(_DIGIT_IN.search(bare))

    def of(self, text: str) -> list[float]:
        lowered = text.lower().split()
        n = len(lowered)
        if not n:
            return [0.0] * len(NAMES)
        counts = Counter(lowered)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, plain_word = self.known, (0.0, False, False, False)
        long = {}
        for w in [w for w in counts if w not in known]:
            found = self.weight(w)
            (known if len(w) <= LONG else long)[w] = None if found == plain_word else found
        marked = {w: k for w in counts if (k := known[w] if w in known else long[w])}
        strong = {w for w, k in marked.items() if k[0] >= 2.0}
        second = {w for w, k in marked.items() if k[2]}
        hits = sum(counts[w] for w in strong)
        weights = sorted((k[0] for k in marked.values() if k[0] > 0), reverse=True)
        near = 0
        if strong and second:
            at = np.array([i for i, w in enumerate(lowered) if w in strong])
            other = np.array([i for i, w in enumerate(lowered) if w in second])
            places = np.searchsorted(other, at)
            gap = np.minimum(np.abs(other[np.minimum(places, len(other) - 1)] - at),
                             np.abs(other[np.maximum(places - 1, 0)] - at))
            near = int((gap <= 4).sum())
        letters = max(1, len(text) - text.count(" "))
        return [
            float(hits), float(len(strong)), hits / n, weights[0] if weights else 0.0,
            sum(k[0] * counts[w] for w, k in marked.items()) / n,
            float(sum(counts[w] for w, k in marked.items() if k[1])), float(near), sum(counts[w] for w in second) / n,
            len(_UPPER.findall(text)) / letters, len(_UPPER_WORD.findall(text)) / n,
            sum(map(text.count, ".,;:!?")) / n, text.count("!") / n,
            sum(counts[w] for w, k in marked.items() if k[3]) / n, len(_RUN.findall(text)) / n,
            letters / n, math.log1p(n), sum(weights[:5]),
        ]


_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_UPPER_WORD = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")
_DIGIT_IN = re.compile(r"[a-z][0-9@$*]+[a-z]")


def featured(text: Column, lexicon: dict[str, float]) -> Column:
    """The feature array of a text column, in Arrow batches; null is empty."""
    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Features(lexicon).of
        for texts in batches:
            yield texts.map(lambda t: of(t) if isinstance(t, str) else of(""))

    return features(text)


def learned_lexicon(rows: DataFrame, support: int = SUPPORT) -> dict[str, float]:
    """Words and prefixes that mark the positive class, with their log odds; at most LEXICON of them.

    ``rows`` (text, label) is the bounded fitting sample; only the strongest entries reach the driver.
    """
    @F.pandas_udf("array<string>")
    def distinct_terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({x for w in set((t or "").lower().split())
                                           for x in terms(w.strip(EDGES)) if x}))

    totals = rows.agg(F.sum("label").alias("p"), F.count("*").alias("n")).first()
    positive, negative = int(totals["p"] or 0), int(totals["n"] - (totals["p"] or 0))
    counted = rows.select("label", F.explode(distinct_terms("text")).alias("term")).groupBy("term").agg(
        F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("q"))
    odds = F.log((F.col("p") + 0.25) / (positive + 0.5)) - F.log((F.col("q") + 0.25) / (negative + 0.5))
    best = (
        counted.where(F.col("p") >= support).withColumn("odds", odds).where(F.col("odds") >= 1.5)
        .orderBy(F.desc(F.col("odds") * F.sqrt("p")), "term").limit(LEXICON).collect())
    return {r["term"]: float(r["odds"]) for r in best}


@dataclass
class Scorer:
    """A fitted model; ``trees`` is None where the labels could not tell two classes apart."""

    lexicon: dict[str, float]
    prior: float
    trees: Model | None = None
    scale: Model | None = None

    def add(self, docs: DataFrame, text_col: str, out: str) -> DataFrame:
        """``docs`` with the score in column ``out``; all other columns as they were."""
        if self.trees is None:
            return docs.withColumn(out, F.lit(self.prior))
        row = docs.select(F.struct("*").alias("t_row"), featured(F.col(text_col).cast("string"), self.lexicon).alias("t_x"))
        raw = self.raw(row.withColumn("features", array_to_vector("t_x")))
        scored = self.scale.transform(raw)
        blended = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 0.98 * F.col("t_scaled") + 0.02 * F.col("t_raw")))
        return scored.select("t_row", blended.alias("t_score")).select("t_row.*", F.col("t_score").alias(out))

    def raw(self, rows: DataFrame) -> DataFrame:
        return raw_score(self.trees, rows)


def raw_score(trees: Model, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("t_raw", F.get(vector_to_array("t_probability"), F.lit(1)))


def held_out(doc_id: Column) -> Column:
    """Rows that no model learns from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def drawn(fitting: DataFrame, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` of the rows (t_id, label), with the number of rows that each stands for as ``weight``.

    The rarer class is thinned only beyond RARE_SHARE of the sample or its own share, whichever is more.
    """
    sizes = {r["label"]: r["count"] for r in fitting.groupBy("label").count().collect()}
    rare, total = min((0, 1), key=lambda y: sizes.get(y, 0)), sum(sizes.values())
    most = {rare: max(sample_rows * RARE_SHARE, sample_rows * sizes.get(rare, 0) / max(1, total))}
    most[1 - rare] = sample_rows - min(most[rare], sizes.get(rare, 0))
    share = {y: min(1.0, most[y] / max(1, sizes.get(y, 0))) for y in (0, 1)}
    spot = F.pmod(F.xxhash64("t_id", F.lit(17)), F.lit(1_000_000_000)) / 1e9
    own = F.when(F.col("label") == 1, share[1]).otherwise(share[0])
    return fitting.where(spot < own).withColumn("weight", 1 / own)


def fitted_trees(shaped: DataFrame, least: int = 5) -> Model:
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, stepSize=0.2, seed=7, minInstancesPerNode=least,
                          weightCol="weight", predictionCol="t_class")
    return trees.setProbabilityCol("t_probability").setRawPredictionCol("t_margin").fit(shaped.coalesce(6))


def calibrated(raw: DataFrame) -> Model:
    return IsotonicRegression(featuresCol="t_raw", labelCol="label", weightCol="weight", predictionCol="t_scaled").fit(raw)


def shaped_rows(rows: DataFrame, part: str, lexicon: dict[str, float]) -> DataFrame:
    return rows.select(part, F.col("label").cast("double").alias("label"), "weight", featured(F.col("text"), lexicon).alias("x"))


def with_vector(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector("x")).drop("x")


def fit_by_parts(rows: DataFrame, prior: float) -> Scorer:
    """The lexicon, the trees and the calibration from separate tenths of the documents."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("t_id", F.lit(5)), F.lit(10)))
    lexicon = learned_lexicon(rows.where(F.col("part") < 4))
    ready = with_vector(stored(shaped_rows(rows.where(F.col("part") >= 4), "part", lexicon)))
    scorer = Scorer(lexicon, prior, fitted_trees(ready.where(F.col("part") < 8)))
    scorer.scale = calibrated(scorer.raw(ready.where(F.col("part") >= 8)))
    return scorer


def fit_by_folds(rows: DataFrame, prior: float, least: int) -> Scorer:
    """All three from all rows: features and raw scores that are fitted on are of models that have not seen the row's fold.

    Every fold holds documents of both classes; ``least`` is the number of documents of the rarer one, 2 or more.
    """
    folds, support, leaf = min(FOLDS, least), max(2, min(SUPPORT, least // 4)), max(1, min(5, least // 4))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("t_id", F.lit(5)), "t_id"))
    ids = rows.select("t_id", "label").distinct().withColumn("fold", F.pmod(place, F.lit(folds))).select("t_id", "fold")
    dealt = stored(rows.join(ids, "t_id"))

    def apart(table: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
        return [(table.where(F.col("fold") != k), table.where(F.col("fold") == k)) for k in range(folds)]

    shaped = reduce(DataFrame.union, (shaped_rows(own, "fold", learned_lexicon(rest, support)) for rest, own in apart(dealt)))
    ready = with_vector(stored(shaped))
    raw = reduce(DataFrame.union, (raw_score(fitted_trees(rest, leaf), own).select("label", "weight", "t_raw")
                                   for rest, own in apart(ready)))
    return Scorer(learned_lexicon(dealt, support), prior, fitted_trees(ready, leaf), calibrated(raw))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Scorer:
    """A scorer from the labelled rows that are not held out.

    The lexicon, the trees and the calibration are fitted on separate parts of a bounded sample, or by folds
    if a class is small. Labels without a document, rows with a null id, label or both, and repeated labels of an id
    (the largest counts) do no harm. The share of positives is the score of all only where a class has no second
    document, so that none is left to learn from when one is set apart.
    """
    bounded_batches(docs.sparkSession)
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("t_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    fitting = known.where(~held_out(F.col("t_id")))
    prior = float(fitting.agg(F.avg("label")).first()[0] or 0.0)
    texts = docs.select(F.col(id_col).alias("t_id"), F.col(text_col).cast("string").alias("text"))
    found = stored(fitting.join(texts.select("t_id"), "t_id", "left_semi"))
    rows = stored(texts.join(small(drawn(found, sample_rows), 2 * sample_rows), "t_id"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count_distinct("t_id").alias("n")).collect()}
    least = min(sizes.get(y, 0) for y in (0, 1))
    if least < 2:
        return Scorer({}, prior)
    return fit_by_parts(rows, prior) if least >= FEW else fit_by_folds(rows, prior, least)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    Null and empty texts have the features of no words and a score; null ids stay null and are not held out;
    repeated rows are scored each; other columns are not read; no rows give no rows.
    """
    scorer = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return scorer.add(rows, "text", "score").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
