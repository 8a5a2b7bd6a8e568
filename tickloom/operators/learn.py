"""Classifiers, clusterings and batch scoring on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import BisectingKMeans, GaussianMixture, KMeans
from pyspark.ml.feature import PCA, ElementwiseProduct, HashingTF, IDF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.scalar import WORD
from tickloom.operators.features import SCREEN, screen_latest
from tickloom.operators.rows import best_by_score
from tickloom.operators.scaling import fit_standard, standardize
from tickloom.plans import DAILY, Series

SEED = 42


def fit_buy_classifier(
    train: DataFrame, cols: Sequence[str] = tuple(SCREEN), label: str = "label", c: float = 1.0
) -> PipelineModel:
    """Logistic regression with an L2 penalty of strength 1/c on the summed loss."""
    n = train.count()
    model = LogisticRegression(
        featuresCol="_x", labelCol=label, probabilityCol="_p", rawPredictionCol="_raw",
        standardization=False, elasticNetParam=0.0, regParam=1.0 / (c * max(n, 1)),
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="_x"), model]).fit(train)


def classify(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predicted class and the probability of class 1."""
    return (
        model.transform(df)
        .withColumn("probability", vector_to_array("_p")[1])
        .withColumn("prediction", F.col("prediction").cast("int"))
        .drop("_x", "_p", "_raw")
    )


def recommend_best(
    df: DataFrame, model: PipelineModel, rows: int = 50, series: Series = DAILY
) -> DataFrame:
    """The stock most likely a buy, judged on its last ``rows`` rows only."""
    ready = screen_latest(df, rows, series).na.drop("any", subset=SCREEN)
    scored = classify(model, ready).select(*series.keys, "probability")
    return best_by_score(scored, "probability", *series.keys)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])))


def pca(
    df: DataFrame, cols: Sequence[str], k: int = 10, out: str = "components"
) -> DataFrame:
    """Principal components of the standardized columns.

    Each component's sign is fixed by making its largest loading positive.
    """
    scaled = standardize(df, fit_standard(df, cols), cols)
    vectors = scaled.select(*[c for c in df.columns if c not in cols], *cols)
    vectors = assemble(vectors, cols, "_x")
    k = min(k, len(cols), df.count())
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(vectors)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    flip = ElementwiseProduct(
        scalingVec=Vectors.dense(np.where(signs == 0, 1.0, signs)), inputCol="_pc", outputCol=out
    )
    return flip.transform(model.transform(vectors)).select(
        *[c for c in df.columns if c not in cols], out
    )


def kmeans(df: DataFrame, k: int = 10, features: str = "features", out: str = "cluster") -> DataFrame:
    return KMeans(k=k, seed=SEED, featuresCol=features, predictionCol=out).fit(df).transform(df)


def gmm(df: DataFrame, k: int = 10, features: str = "features", out: str = "cluster") -> DataFrame:
    model = GaussianMixture(
        k=k, seed=SEED, featuresCol=features, predictionCol=out, probabilityCol="_p"
    ).fit(df)
    return model.transform(df).drop("_p")


def hierarchical(
    df: DataFrame, k: int = 10, features: str = "features", out: str = "cluster"
) -> DataFrame:
    """Top-down hierarchical clustering.

    A cluster is split by moving its centre by a share of the centre's length, so centred data would
    never be split. A constant component changes no distance and keeps that length from zero.
    """
    lifted = VectorAssembler(inputCols=[features, "_one"], outputCol="_lifted").transform(
        df.withColumn("_one", F.lit(1.0))
    )
    model = BisectingKMeans(k=k, seed=SEED, featuresCol="_lifted", predictionCol=out).fit(lifted)
    return model.transform(lifted).drop("_one", "_lifted")


def summary_cluster(
    df: DataFrame, k: int = 10, micro: int = 100, features: str = "features", out: str = "cluster"
) -> DataFrame:
    """Cluster many small groups first, then the groups' weighted centroids."""
    fine = KMeans(k=micro, seed=SEED, featuresCol=features, predictionCol="_micro").fit(df).transform(df)
    centres = fine.groupBy("_micro").agg(
        Summarizer.mean(F.col(features)).alias("_centre"),
        F.count(F.lit(1)).cast("double").alias("_weight"),
    )
    coarse = KMeans(
        k=k, seed=SEED, featuresCol="_centre", predictionCol=out, weightCol="_weight"
    ).fit(centres)
    # One row per micro cluster, at most ``micro`` rows.
    labels = coarse.transform(centres).select("_micro", out)
    return fine.join(F.broadcast(labels), "_micro").drop("_micro")


def silhouette(df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Mean silhouette under squared Euclidean distance, in linear time; NULL for one cluster."""
    x = vector_to_array(features)
    square = F.aggregate(x, F.lit(0.0), lambda t, v: t + v * v)
    points = df.select(F.col(cluster).alias("_c"), x.alias("_x"), square.alias("_sq"), F.col(features).alias("_v"))
    # One row per cluster: its size, centre and mean square. They give a point's mean distance to all members.
    each = points.groupBy("_c").agg(
        F.count(F.lit(1)).alias("n"), Summarizer.mean(F.col("_v")).alias("m"), F.avg("_sq").alias("q")
    ).select(F.struct(F.col("_c").alias("c"), "n", vector_to_array("m").alias("m"), "q").alias("s"))
    scored = points.withColumn("_all", each.agg(F.collect_list("s")).scalar())

    def apart(s):
        dot = F.aggregate(F.zip_with("_x", s["m"], lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)
        return F.greatest(F.col("_sq") + s["q"] - 2 * dot, F.lit(0.0))

    own = F.filter("_all", lambda s: s["c"] == F.col("_c"))[0]
    inner = F.when(own["n"] > 1, apart(own) * own["n"] / (own["n"] - 1))
    outer = F.array_min(F.transform(F.filter("_all", lambda s: s["c"] != F.col("_c")), apart))
    near = scored.select(inner.alias("_in"), outer.alias("_out"))
    # A point alone in its cluster scores 0; without a second cluster there is no score.
    score = F.when(F.col("_out").isNotNull(), F.coalesce(
        F.try_divide(F.col("_out") - F.col("_in"), F.greatest("_out", "_in")), F.lit(0.0)))
    return near.agg(F.avg(score).alias("silhouette"))


def fit_sentiment(train: DataFrame, text: str = "text", label: str = "label") -> PipelineModel:
    """Binary text classifier over hashed, weighted words."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=WORD, gaps=False),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=1 << 16),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(
            featuresCol="_tfidf", labelCol=label, probabilityCol="_p", rawPredictionCol="_raw",
            regParam=0.01, maxIter=50,
        ),
    ]).fit(train)


def sentiment_classify(model: PipelineModel, df: DataFrame) -> DataFrame:
    """'positive' or 'negative' for every text."""
    word = F.when(F.col("prediction") == 1, "positive").otherwise("negative")
    return (
        model.transform(df).withColumn("sentiment", word)
        .drop("_words", "_tf", "_tfidf", "_p", "_raw", "prediction")
    )


def score_batches(
    df: DataFrame,
    load: Callable[[], Callable[[pd.DataFrame], pd.Series]],
    cols: Sequence[str],
    out: str = "score",
    kind: T.DataType = T.DoubleType(),
) -> DataFrame:
    """Apply an injected model to Arrow batches; ``load`` runs once per task."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, kind)])
    cols = list(cols)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            yield batch.assign(**{out: predict(batch[cols])})

    return df.mapInPandas(score, schema)
