import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom.operators import aggregate as agg
from tickloom.operators import features, forecast, learn, rows


def test_ar_recovers_a_noiseless_path(spark):
    x = [10.0, 3.0]
    for _ in range(40):
        x.append(1.0 + 0.5 * x[-1] - 0.3 * x[-2])
    pdf = make_bars({"A": 42}).assign(close=x)
    out = by_series(forecast.ar_forecast(to_spark(spark, pdf[:30]), p=2, d=0, h=12), "step")
    assert close_to(out["forecast"], x[30:], 1e-6)
    assert (out["upper"] - out["lower"] < 1e-4).all()


@pytest.mark.parametrize("p,d", [(1, 0), (1, 1), (5, 1), (3, 2)])
def test_forecast_bounds(spark, p, d):
    df = to_spark(spark, make_bars({"A": 200, "SHORT": 3}))
    out = by_series(forecast.ar_forecast(df, p=p, d=d, h=6), "step")
    assert set(out["symbol"]) == {"A"} and list(out["step"]) == list(range(1, 7))
    assert ((out["lower"] <= out["forecast"]) & (out["forecast"] <= out["upper"])).all()
    assert (out["upper"] - out["lower"]).is_monotonic_increasing


def test_ar_fit_is_least_squares(spark):
    pdf = make_bars({"A": 120})
    out = by_series(forecast.ar_forecast(to_spark(spark, pdf), p=3, d=1, h=1), "step")
    z = np.diff(pdf["close"])
    design = np.column_stack([np.ones(len(z) - 3), z[2:-1], z[1:-2], z[:-3]])
    beta = np.linalg.lstsq(design, z[3:], rcond=None)[0]
    step = beta @ [1, z[-1], z[-2], z[-3]]
    assert out["forecast"][0] == pytest.approx(pdf["close"].iloc[-1] + step, rel=1e-9)


def test_samples_and_future(spark):
    df = rows.row_index(to_spark(spark, make_bars({"A": 20})))
    out = by_series(forecast.forecast_samples(df, ["time_idx"], ["close"], 6, 3))
    assert len(out) == 20 - 2 - 1
    assert list(out["encoder_length"][:4]) == [3, 4, 5, 6]
    row = out.iloc[5]
    assert [e["time_idx"] for e in row["decoder"]] == [row["encoder"][-1]["time_idx"] + i for i in (1, 2, 3)]
    base = df.withColumn("month", F.month("date"))
    ahead = by_series(forecast.future_frame(base, 4), "time_idx")
    assert list(ahead["time_idx"]) == list(range(24))
    assert [(b - a).days for a, b in zip(ahead["date"][19:], ahead["date"][20:])] == [1] * 4
    assert list(ahead["close"][20:]) == list(ahead["close"][16:20])


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    points = np.concatenate([rng.normal(c, 0.1, (30, 3)) for c in (0.0, 5.0, -5.0)])
    return spark.createDataFrame(
        [(i, [float(v) for v in p]) for i, p in enumerate(points)], "id bigint, v array<double>"
    ).select("id", array_to_vector("v").alias("features")).cache()


@pytest.mark.parametrize("method", [
    learn.kmeans, learn.gmm, learn.hierarchical, lambda df, k: learn.summary_cluster(df, k, micro=9)
], ids=["kmeans", "gmm", "hierarchical", "summary"])
def test_clusterings_find_blobs(blobs, method):
    out = method(blobs, 3)
    labels = out.select("id", "cluster").toPandas().sort_values("id")["cluster"].to_numpy()
    assert [len(set(labels[i:i + 30])) for i in (0, 30, 60)] == [1, 1, 1] and len(set(labels)) == 3
    assert 0.9 < learn.silhouette(out).first().silhouette <= 1


def test_silhouette_of_one_cluster_is_missing(blobs):
    assert learn.silhouette(blobs.withColumn("cluster", F.lit(0))).first().silhouette is None


def test_pca_sign_and_variance(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=50)
    pdf = pd.DataFrame({"a": base, "b": -base + rng.normal(0, 0.01, 50), "c": rng.normal(size=50)})
    df = spark.createDataFrame(pdf)
    out = learn.pca(df, ["a", "b", "c"], k=2).toPandas()["components"]
    first = np.array([v[0] for v in out])
    assert first.var() == pytest.approx(2.0, rel=0.05) and abs(first.mean()) < 1e-9


def test_classifier_and_recommendation(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > 0).astype(int)
    train = spark.createDataFrame(
        [(*map(float, r), int(l)) for r, l in zip(x, y)], "macd double, rsi double, band_position double, label int"
    )
    model = learn.fit_buy_classifier(train)
    scored = learn.classify(model, train)
    assert scored.filter("prediction = label").count() > 370
    assert scored.filter("probability < 0 or probability > 1").count() == 0
    best = learn.recommend_best(to_spark(spark, make_bars({"A": 80, "B": 60, "C": 10})), model).collect()
    assert len(best) == 1 and best[0].symbol in {"A", "B"}


def test_latest_features_restart_at_the_slice(spark):
    pdf = make_bars({"A": 120})
    got = features.screen_latest(to_spark(spark, pdf)).first()
    tail = features.screen(to_spark(spark, pdf[-50:])).orderBy(F.desc("date")).first()
    assert got.macd == pytest.approx(tail.macd) and got.rsi == pytest.approx(tail.rsi)


def test_sentiment(spark):
    texts = [(i, "profits rise strong gain" if i % 2 else "losses fall weak debt", i % 2) for i in range(40)]
    df = spark.createDataFrame(texts, "id int, text string, label int")
    out = learn.sentiment_classify(learn.fit_sentiment(df), df)
    assert {(r.label, r.sentiment) for r in out.collect()} == {(1, "positive"), (0, "negative")}


def test_score_batches(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 1.0)
    out = learn.score_batches(df, lambda: lambda b: b["x"] * 2, ["x"]).collect()
    assert all(r.score == 2 * r.x for r in out)


def test_hierarchical_splits_centred_data(spark):
    """The centre of all points is zero."""
    points = [([x + dx, y + dx],) for x in (-5.0, 5.0) for y in (-5.0, 5.0) for dx in (-0.1, 0.1)]
    df = spark.createDataFrame(points, "a array<double>").select(array_to_vector("a").alias("features"))
    out = learn.hierarchical(df, 4)
    assert out.columns == ["features", "cluster"]
    assert out.select("cluster").distinct().count() == 4


def test_latest_values_need_no_sort(spark):
    df = spark.range(10).selectExpr("'A' AS symbol", "date_add(DATE '2020-01-01', cast(id AS int)) AS date", "id * 1.0D AS x")
    out = agg.latest_snapshot(df, ["x", "date"])
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()["x"] == 9.0
