"""Checks of scaling, splits, learning and forecasting."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sqltext as t
from checks.registry import check, cut, rounded
from checks.views import BARS, bars, labelled_docs, table, ticks, vectors
from tickloom.operators import aggregate as agg
from tickloom.operators import features, forecast, learn, rows, scaling
from tickloom.plans import Series
from tickloom.plans.scratch import stored

ID = ("symbol", "date")
COLS = ["close", "volume"]
FIT = """
fit AS (SELECT avg(close) AS mc, stddev_pop(close) AS sc, avg(volume) AS mv, stddev_pop(volume) AS sv,
               min(close) AS lc, max(close) AS hc, min(volume) AS lv, max(volume) AS hv
        FROM numbered WHERE t < len - 130)"""


def train(spark, folder):
    return scaling.split_temporal(bars(spark, folder), {"train": (None, -130)})["train"]


@check("standardize", *t.STEPS, FIT, sql=f"""
SELECT symbol, date, {cut("(close - mc) / sc")} AS close, {cut("(volume - mv) / sv")} AS volume,
       {cut("close")} AS restored FROM numbered, fit""")
def q_standardize(spark, folder):
    stats = scaling.fit_standard(train(spark, folder), COLS)
    out = scaling.standardize(bars(spark, folder).select(*ID, *COLS), stats, COLS)
    out = scaling.unstandardize(
        out.withColumn("restored", F.col("close")), stats, {"restored": "close"}
    )
    return rounded(out, *COLS, "restored")


@check("minmax_scale", *t.STEPS, FIT, sql=f"""
SELECT symbol, date, {cut("(close - lc) / (hc - lc)")} AS close,
       {cut("(volume - lv) / (hv - lv)")} AS volume, {cut("close")} AS restored FROM numbered, fit""")
def q_minmax(spark, folder):
    stats = scaling.fit_minmax(train(spark, folder), COLS)
    out = scaling.minmax_scale(bars(spark, folder).select(*ID, *COLS), stats, COLS)
    out = scaling.minmax_unscale(
        out.withColumn("restored", F.col("close")), stats, {"restored": "close"}
    )
    return rounded(out, *COLS, "restored")


@check("group_normalize", *t.STEPS, """
soft AS (SELECT *, close + ln(1 - exp(-close)) AS y FROM numbered)""", sql=f"""
SELECT symbol, date, {cut('''(y - avg(y) OVER (PARTITION BY symbol))
       / stddev_samp(y) OVER (PARTITION BY symbol)''')} AS z, {cut("close")} AS restored FROM soft""")
def q_group_normalize(spark, folder):
    b = bars(spark, folder).select(*ID, F.col("close").alias("z"))
    stats = scaling.fit_group(b, "z", ["symbol"])
    out = scaling.group_normalize(b, stats, "z", ["symbol"]).withColumn("restored", F.col("z"))
    return rounded(scaling.group_denormalize(out, stats, "restored", ["symbol"]), "z", "restored")


@check("split_temporal", *t.STEPS, sql="""
SELECT symbol, date, part FROM (
  SELECT symbol, date, unnest(list_filter(
    [CASE WHEN t BETWEEN len - 1000 AND len - 131 THEN 'train' END,
     CASE WHEN t BETWEEN len - 1000 AND len - 66 THEN 'val' END,
     CASE WHEN t >= len - 430 THEN 'test' END], lambda x: x IS NOT NULL)) AS part
  FROM numbered)""")
def q_split_temporal(spark, folder):
    parts = scaling.split_temporal(
        bars(spark, folder).select(*ID),
        {"train": (-1000, -130), "val": (-1000, -65), "test": (-430, None)},
    )
    labelled = [p.withColumn("part", F.lit(n)) for n, p in parts.items()]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@check("split_random", BARS, sql="""
SELECT symbol, date,
       CASE WHEN CAST('0x' || substr(md5('42|' || symbol || '|' || CAST(date AS VARCHAR)), 1, 8) AS BIGINT)
                 / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS part FROM bars""")
def q_split_random(spark, folder):
    fit, test = scaling.split_random(bars(spark, folder).select(*ID), 0.2, ID)
    return fit.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def screened(spark, folder):
    """Labelled prefix features, written once: the classifier reads them many times."""
    out = rows.rule_label(features.expanding_features(bars(spark, folder)))
    return stored(out.select(*ID, *features.SCREEN, "label").na.drop("any"))


@check("buy_classifier")
def q_buy_classifier(spark, folder):
    fit, test = scaling.split_random(screened(spark, folder), 0.2, ID)
    model = learn.fit_buy_classifier(fit)
    return agg.accuracy(learn.classify(model, test), "label", "prediction", ["symbol"])


@check("recommend_best")
def q_recommend(spark, folder):
    model = learn.fit_buy_classifier(screened(spark, folder))
    return learn.recommend_best(bars(spark, folder), model)


@check("screen_latest", *t.STEPS, """
tail AS (SELECT symbol, date, open, high, low, close, volume, t - (len - 50) AS t, 50 AS len
         FROM numbered WHERE t >= len - 50)""", t.MOVES.replace("FROM numbered", "FROM tail"),
       t.ROLL, t.REC, t.BOTH, t.SCREEN, recursive=True, sql=f"""
SELECT symbol, {cut("macd")} AS macd, {cut("rsi")} AS rsi, {cut("band_position")} AS band_position
FROM screen WHERE t = 49""")
def q_screen_latest(spark, folder):
    """Indicators restarted on the last 50 rows, the input of the recommendation."""
    return rounded(features.screen_latest(bars(spark, folder)), *features.SCREEN)


def stock_vectors(spark, folder):
    """Components of the standardized stock features, missing ones at their mean."""
    filled = rows.fill_mean(stored(features.stock_features(bars(spark, folder))), features.VECTOR)
    return learn.pca(filled, features.VECTOR, out="features")


def embedded(spark, folder):
    """Components of the embeddings, a wider input for the same steps."""
    names = [f"v{i}" for i in range(64)]
    wide = vectors(spark, folder).select(
        "vec_id", *[F.col("v")[i].alias(c) for i, c in enumerate(names)]
    )
    return stored(learn.pca(wide, names, out="features"))


@check("pca")
def q_pca(spark, folder):
    out = stock_vectors(spark, folder)
    return out.select("symbol", F.posexplode(vector_to_array("features")).alias("component", "value"))


def clustering(name, method):
    @check(name)
    def stocks(spark, folder):
        out = method(stored(stock_vectors(spark, folder)), 10)
        return out.select("symbol", "cluster")

    @check(f"{name}_vectors")
    def wide(spark, folder):
        return method(embedded(spark, folder), 10).select("vec_id", "cluster")


clustering("kmeans", learn.kmeans)
clustering("gmm", learn.gmm)
clustering("hierarchical", learn.hierarchical)
clustering("summary_cluster", lambda df, k: learn.summary_cluster(df, k, micro=50))


@check("silhouette")
def q_silhouette(spark, folder):
    data = embedded(spark, folder)
    methods = {
        "kmeans": learn.kmeans,
        "gmm": learn.gmm,
        "hierarchical": learn.hierarchical,
        "summary_cluster": lambda df, k: learn.summary_cluster(df, k, micro=50),
    }
    scores = [
        learn.silhouette(method(data, 10)).withColumn("method", F.lit(name)) for name, method in methods.items()
    ]
    return reduce(DataFrame.unionByName, scores)


@check("silhouette_labels", """
x AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, list_sum(list_transform(embedding::DOUBLE[], lambda e: e * e)) AS sq
      FROM embeddings)""", """
u AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS e FROM x)""", """
m AS (SELECT label, list(e ORDER BY i) AS m FROM (SELECT label, i, avg(e) AS e FROM u GROUP BY ALL) GROUP BY label)""", """
c AS (SELECT label, m, n, q FROM m JOIN (SELECT label, count(*) AS n, avg(sq) AS q FROM x GROUP BY label) USING (label))""", """
d AS (SELECT vec_id, x.label AS own, c.label AS other, n, greatest(sq + q - 2 * list_dot_product(v, m), 0) AS d
      FROM x, c)""", """
s AS (SELECT vec_id, min(CASE WHEN own = other AND n > 1 THEN d * n / (n - 1) END) AS a,
             min(CASE WHEN own <> other THEN d END) AS b FROM d GROUP BY vec_id)""", sql=f"""
SELECT {cut("avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END)")} AS silhouette
FROM s""")
def q_silhouette_labels(spark, folder):
    """The score of the given labels."""
    data = vectors(spark, folder).select("label", array_to_vector("v").alias("features"))
    return rounded(learn.silhouette(data, cluster="label"), "silhouette")


@check("pca_variance", sql="""
SELECT i, j, CASE WHEN i = j THEN 1.0 ELSE 0.0 END AS correlation, 64.0::DOUBLE AS total
FROM (SELECT unnest(generate_series(0, 9)) AS i), (SELECT unnest(generate_series(0, 9)) AS j) WHERE i <= j""")
def q_pca_variance(spark, folder):
    """Variances of all components add up to the number of columns; the ten of the query are uncorrelated."""
    names = [f"v{i}" for i in range(64)]
    wide = vectors(spark, folder).select("vec_id", *[F.col("v")[i].alias(c) for i, c in enumerate(names)])
    parts = learn.pca(wide, names, k=64).select("vec_id", vector_to_array("components").alias("p"))
    one = parts.select([F.col("p")[i].alias(f"p{i}") for i in range(64)])
    total = sum((F.var_pop(f"p{i}") for i in range(1, 64)), F.var_pop("p0"))
    pairs = [F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(j).cast("bigint").alias("j"),
                      F.corr(f"p{i}", f"p{j}").alias("correlation"))
             for i in range(10) for j in range(i, 10)]
    table_ = one.agg(total.alias("total"), F.array(*pairs).alias("pairs"))
    out = table_.select(F.inline("pairs"), F.round("total", 6).alias("total"))
    return out.withColumn("correlation", F.round("correlation", 6) + 0.0)


@check("sentiment_classify")
def q_sentiment(spark, folder):
    """Every document, by a model of four fifths of the labelled ones."""
    docs = stored(labelled_docs(spark, folder))
    fit, _ = scaling.split_random(docs, 0.2, ["doc_id"])
    model = learn.fit_sentiment(fit)
    return learn.sentiment_classify(model, table(spark, folder, "documents")).select("doc_id", "sentiment")


def load_linear():
    # Weights of the injected linear scorer.
    weights = np.array([0.5, -0.25, 2.0])
    return lambda batch: pd.Series(batch.to_numpy() @ weights, index=batch.index)


@check("score_batches", BARS, sql=f"""
SELECT symbol, date, {cut("0.5 * close - 0.25 * open + 2 * volume")} AS score FROM bars""")
def q_score(spark, folder):
    out = learn.score_batches(bars(spark, folder), load_linear, ["close", "open", "volume"])
    return rounded(out.select(*ID, "score"), "score")


@check("ar_forecast", *t.STEPS, """
z AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY t) AS z FROM numbered)""", """
lagged AS (SELECT *, lag(z) OVER (PARTITION BY symbol ORDER BY t) AS z1 FROM z)""", """
fitted AS (
  SELECT symbol, regr_slope(z, z1) AS phi, regr_intercept(z, z1) AS c,
         sqrt((regr_syy(z, z1) - regr_slope(z, z1) * regr_sxy(z, z1)) / (regr_count(z, z1) - 2)) AS s,
         arg_max(z, t) AS last_z, arg_max(close, t) AS last_close
  FROM lagged GROUP BY symbol)""", """
path AS (
  SELECT symbol, 1 AS step, c + phi * last_z AS z, last_close + c + phi * last_z AS y,
         1.0::DOUBLE AS psi, 1.0::DOUBLE AS total, s, c, phi FROM fitted
  UNION ALL
  SELECT symbol, step + 1, c + phi * z, y + c + phi * z, 1 + phi * psi,
         total + (1 + phi * psi) ** 2, s, c, phi FROM path WHERE step < 10)""", recursive=True, sql=f"""
SELECT symbol, step, {cut("y")} AS forecast, {cut("y - 1.959963984540054 * s * sqrt(total)")} AS lower,
       {cut("y + 1.959963984540054 * s * sqrt(total)")} AS upper FROM path""")
def q_ar(spark, folder):
    out = forecast.ar_forecast(bars(spark, folder), p=1, d=1, h=10)
    return rounded(out, "forecast", "lower", "upper")


@check("ar_forecast_second", *t.STEPS, """
z AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY t) AS z FROM numbered)""", """
lagged AS (SELECT *, lag(z) OVER (PARTITION BY symbol ORDER BY t) AS z1,
                  lag(z, 2) OVER (PARTITION BY symbol ORDER BY t) AS z2 FROM z)""", """
sums AS (
  SELECT symbol, count(*) AS n, avg(z) AS m, avg(z1) AS m1, avg(z2) AS m2, var_pop(z) AS v, var_pop(z1) AS v11,
         var_pop(z2) AS v22, covar_pop(z1, z2) AS v12, covar_pop(z, z1) AS c1, covar_pop(z, z2) AS c2
  FROM lagged WHERE z2 IS NOT NULL GROUP BY symbol)""", """
solved AS (SELECT *, (c1 * v22 - c2 * v12) / (v11 * v22 - v12 * v12) AS a,
                  (c2 * v11 - c1 * v12) / (v11 * v22 - v12 * v12) AS b FROM sums)""", """
ends AS (SELECT symbol, arg_max(z, t) AS z1, arg_max(z1, t) AS z2, arg_max(close, t) AS y FROM lagged GROUP BY symbol)""", """
path AS (
  SELECT symbol, 0 AS step, z1, z2, y, 0.0::DOUBLE AS p1, 0.0::DOUBLE AS p2, 0.0::DOUBLE AS p3, 0.0::DOUBLE AS total,
         a, b, m - a * m1 - b * m2 AS c, sqrt(n * (v - a * c1 - b * c2) / (n - 3)) AS s
  FROM solved JOIN ends USING (symbol)
  UNION ALL
  SELECT symbol, step + 1, z, z1, y + z, p, p1, p2, total + p * p, a, b, c, s
  FROM (SELECT *, c + a * z1 + b * z2 AS z,
               CASE WHEN step = 0 THEN 1 ELSE (1 + a) * p1 + (b - a) * p2 - b * p3 END AS p
        FROM path WHERE step < 10))""", recursive=True, sql=f"""
SELECT symbol, step, {cut("y / 1000")} AS forecast, {cut("(y - 1.959963984540054 * s * sqrt(total)) / 1000")} AS lower,
       {cut("(y + 1.959963984540054 * s * sqrt(total)) / 1000")} AS upper FROM path WHERE step > 0""")
def q_ar_second(spark, folder):
    """Two lags, in thousands: the SQL solves them by Cramer's rule, which agrees to about nine digits."""
    out = forecast.ar_forecast(bars(spark, folder), p=2, d=1, h=10)
    out = out.withColumns({c: F.col(c) / 1000 for c in ("forecast", "lower", "upper")})
    return rounded(out, "forecast", "lower", "upper")


@check("ar_forecast_long")
def q_ar_long(spark, folder):
    return forecast.ar_forecast(bars(spark, folder), p=8, d=1, h=120)


def window_list(col: str, frame: str) -> str:
    return f"list({col}) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN {frame})"


SAMPLES = (*t.STEPS, f"""
sample AS (
  SELECT * FROM (
    SELECT symbol, date, {window_list("close", "364 PRECEDING AND CURRENT ROW")} AS e,
           {window_list("volume", "364 PRECEDING AND CURRENT ROW")} AS v,
           {window_list("close", "1 FOLLOWING AND 65 FOLLOWING")} AS d FROM numbered)
  WHERE len(e) >= 182 AND len(d) >= 1)""")


@check("forecast_samples", *SAMPLES, sql=f"""
SELECT symbol, date, len(e) AS encoder_length, len(d) AS decoder_length, e[1] AS first_value,
       e[-1] AS last_value, {cut("list_sum(v)")} AS volume, d[-1] AS target FROM sample""")
def q_samples(spark, folder):
    """Samples read from blocks that hold each row twice at most."""
    blocks = forecast.sample_blocks(bars(spark, folder), ["volume"], ["close"], 365, 65)
    out = forecast.read_samples(
        blocks, load_summary, ["close", "volume"], ["close"],
        "encoder_length int, decoder_length int, first_value double, last_value double, volume double, target double")
    return rounded(out, "volume")


def load_summary():
    return lambda back, ahead: (len(back), len(ahead), back[0, 0], back[-1, 0], back[:, 1].sum(), ahead[-1, 0])


@check("sample_blocks", *SAMPLES, sql="""
SELECT symbol, len, samples, true AS within FROM (SELECT symbol, count(*) AS len FROM numbered GROUP BY symbol)
JOIN (SELECT symbol, count(*) AS samples FROM sample GROUP BY symbol) USING (symbol)""")
def q_blocks(spark, folder):
    """Blocks hold all samples of a series and no row more than twice."""
    out = forecast.sample_blocks(bars(spark, folder), ["volume"], ["close"], 365, 65)
    opened = out.select("symbol", F.explode("rows").alias("row")).groupBy("symbol").agg(
        F.countDistinct("row.date").alias("len"), F.count(F.lit(1)).alias("held"))
    samples = out.groupBy("symbol").agg(F.sum(F.size("samples")).alias("samples"))
    return opened.join(samples, "symbol").select("symbol", "len", "samples", (F.col("held") <= 2 * F.col("len")).alias("within"))


def load_momentum():
    return lambda back, ahead: (ahead[:, 0].mean() - back[:, 0].mean() + back[:, 1].max(),)


@check("read_samples", *SAMPLES, sql=f"""
SELECT symbol, date, {cut("list_avg(d) - list_avg(e) + list_max(v)")} AS score FROM sample""")
def q_read_samples(spark, folder):
    """A model that reads whole samples, opened inside its batches."""
    blocks = forecast.sample_blocks(bars(spark, folder), ["volume"], ["close"], 365, 65)
    return rounded(forecast.read_samples(blocks, load_momentum, ["close", "volume"], ["close"]), "score")


@check("future_frame", *t.STEPS, """
ends AS (SELECT symbol, max(date) AS last_day, max(t) AS last_t FROM numbered GROUP BY symbol)""", sql="""
SELECT symbol, date, close, t AS time_idx, month(date) AS month FROM numbered
UNION ALL
SELECT symbol, day, close, t + 65, month(day)
FROM (SELECT *, CAST(last_day + CAST(t - (len - 65) + 1 AS INTEGER) AS DATE) AS day
      FROM numbered JOIN ends USING (symbol) WHERE t >= len - 65)""")
def q_future(spark, folder):
    base = rows.row_index(bars(spark, folder)).withColumn("month", F.month("date"))
    return forecast.future_frame(base.select(*ID, "close", "time_idx", "month"), 65)


@check("future_frame_ticks", """
n AS (SELECT user_id, ts, value, row_number() OVER w - 1 AS time_idx, month(ts) AS month,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS back, count(*) OVER (PARTITION BY user_id) AS len
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))""", """
ends AS (SELECT user_id, max(ts) AS last, max(ts) FILTER (back = 2) AS before, max(time_idx) AS top FROM n GROUP BY user_id)""", """
new AS (SELECT user_id, last + (last - before) * CAST(least(len, 20) - back + 1 AS INTEGER) AS ts, value,
               top + least(len, 20) - back + 1 AS time_idx FROM n JOIN ends USING (user_id) WHERE back <= 20)""", sql="""
SELECT user_id, ts, value, time_idx, month FROM n UNION ALL SELECT user_id, ts, value, time_idx, month(ts) FROM new""")
def q_future_ticks(spark, folder):
    """Timestamps go on by the time between a user's last two ticks."""
    ticked = Series("user_id", "ts")
    base = rows.row_index(ticks(spark, folder), "time_idx", ticked).withColumn("month", F.month("ts"))
    return forecast.future_frame(base.select("user_id", "ts", "value", "time_idx", "month"), 20, series=ticked)
