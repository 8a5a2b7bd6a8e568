import pytest
from pyspark.sql import functions as F

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import DAILY, Series
from tickloom.operators import aggregate as agg
from tickloom.operators import asof, rows, scaling

CUT = Series(chunk_rows=8, bucket=10)


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
@pytest.mark.parametrize("bounds", [(0, 5), (-5, None), (3, -4), (None, -2), (None, 6), (-9, -3), (50, None)])
def test_slices_follow_python(spark, series, bounds):
    pdf = make_bars({"A": 30, "B": 4})
    got = by_series(rows.slice_rows(to_spark(spark, pdf), *bounds, series))
    want = pdf.groupby("symbol", group_keys=False)[pdf.columns.tolist()].apply(lambda g: g[slice(*bounds)])
    assert list(got["close"]) == list(want["close"])


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_history_and_positions(spark, series):
    df = to_spark(spark, make_bars({"A": 30, "B": 4}))
    assert {r.symbol for r in rows.min_history(df, 5, series).collect()} == {"A"}
    out = by_series(rows.row_index(df, "i", series))
    assert list(out["i"]) == [*range(30), *range(4)]


def test_stack_and_tile(spark):
    df = to_spark(spark, make_bars({"A": 5, "B": 2}))
    tail = rows.slice_rows(df, -2)
    out = by_series(rows.stack(df, tail, "i"), "i")
    a = out[out.symbol == "A"]
    assert list(a["i"]) == list(range(7))
    assert list(a["close"][5:]) == list(a["close"][3:5])
    tiled = by_series(rows.tile(tail, 3, "i"), "i")
    assert list(tiled[tiled.symbol == "A"]["i"]) == list(range(6))
    assert list(tiled[tiled.symbol == "A"]["close"]) == list(a["close"][3:5]) * 3


def test_recent_sample(spark):
    df = to_spark(spark, make_bars({"A": 50}))
    latest = {r.date for r in df.orderBy(F.desc("date")).limit(20).collect()}
    got = rows.recent_sample(df, 20, 5).collect()
    assert len({r.date for r in got}) == 5 and {r.date for r in got} <= latest
    assert rows.recent_sample(df, 3, 5).count() == 0


def test_forward_fill_inserts_days(spark):
    pdf = make_bars({"A": 20, "B": 1}, gaps=0.3)
    got = by_series(rows.forward_fill(to_spark(spark, pdf), ["close"]))
    one = pdf[pdf.symbol == "A"].assign(date=lambda d: d["date"].astype("datetime64[ns]")).set_index("date")
    want = one["close"].resample("D").last().ffill()
    assert close_to(got[got.symbol == "A"]["close"], want)
    assert (got["symbol"] == "B").sum() == 1


def test_forward_fill_steps_of_positions(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 4, None), ("A", 6, 7.0)], "symbol string, i bigint, x double")
    out = by_series(rows.forward_fill(df, ["x"], Series("symbol", "i")), "i")
    assert list(out["i"]) == [1, 2, 3, 4, 5, 6] and list(out["x"]) == [5, 5, 5, 5, 5, 7]


def test_fill_mean_and_best(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 3.0)], "symbol string, x double")
    assert {r.symbol: r.x for r in rows.fill_mean(df, ["x"]).collect()}["b"] == pytest.approx(7 / 3)
    assert rows.best_by_score(df, "x", "symbol").collect()[0].symbol == "c"


def test_rule_label_missing_is_no_buy(spark):
    df = spark.createDataFrame(
        [(1.0, 50.0, 0.1), (1.0, 70.0, 0.1), (None, 50.0, 0.1), (1.0, 50.0, 0.2)],
        "macd double, rsi double, band_position double",
    )
    assert [r.label for r in rows.rule_label(df).collect()] == [1, 0, 0, 0]


def test_vote_tie_takes_first_model(spark):
    df = spark.createDataFrame(
        [("c1", 0, 1), ("c1", 1, 0), ("c2", 0, 0), ("c2", 1, 1), ("c2", 2, 1), ("c3", 0, 2), ("c3", 1, 1), ("c3", 2, 0)],
        "cell string, model_ord int, action int",
    )
    got = {r.cell: r.action for r in agg.majority_vote(df, ["cell"]).collect()}
    assert got == {"c1": 1, "c2": 1, "c3": 2}


def test_resample_keeps_empty_months(spark):
    df = spark.createDataFrame(
        [("A", "2020-01-30", None), ("A", "2020-01-31", 2.0), ("A", "2020-03-01", 3.0), ("A", "2020-04-02", None)],
        "symbol string, d string, close double",
    ).select("symbol", F.to_date("d").alias("date"), "close")
    out = agg.resample_first(df, "close").orderBy("month").collect()
    assert [(str(r.month), r.close) for r in out] == [
        ("2020-01-01", 2.0), ("2020-02-01", None), ("2020-03-01", 3.0), ("2020-04-01", None)
    ]


def test_losses(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "a double, p double")
    assert agg.mse(df, "a", "p").first().mse == 2.5
    assert agg.mae(df, "a", "p").first().mae == 1.5
    got = {r.quantile: r.pinball for r in agg.pinball_loss(df, "a", "p", [0.1, 0.5]).collect()}
    assert got == {0.1: pytest.approx((0.9 + 0.2) / 2), 0.5: pytest.approx(0.75)}


def test_scalers_invert(spark):
    pdf = make_bars({"A": 20, "B": 20})
    pdf["volume"] = 5.0
    df = to_spark(spark, pdf)
    for fit, forth, back in (
        (scaling.fit_standard, scaling.standardize, scaling.unstandardize),
        (scaling.fit_minmax, scaling.minmax_scale, scaling.minmax_unscale),
    ):
        stats = fit(df, ["close", "volume"])
        scaled = forth(df, stats, ["close", "volume"])
        assert {r.volume for r in scaled.collect()} == {0.0}
        again = by_series(back(scaled, stats, {"close": "close", "volume": "volume"}))
        assert close_to(again["close"], pdf["close"]) and set(again["volume"]) == {5.0}
    stats = scaling.fit_group(df, "close", ["symbol"])
    z = scaling.group_normalize(df, stats, "close", ["symbol"])
    assert abs(z.agg(F.avg("close")).first()[0]) < 1e-9
    assert close_to(by_series(scaling.group_denormalize(z, stats, "close", ["symbol"]))["close"], pdf["close"])


def test_softplus_pair_is_stable(spark):
    values = [1e-6, 0.5, 30.0, 1e5]
    df = spark.createDataFrame([(v,) for v in values], "y double")
    out = df.select(scaling.softplus(scaling.inverse_softplus(F.col("y"))).alias("y")).collect()
    assert [r.y for r in out] == pytest.approx(values, rel=1e-9)


def test_random_split_is_a_partition(spark):
    df = to_spark(spark, make_bars({"A": 300, "B": 300}))
    fit, test = scaling.split_random(df, 0.2, ["symbol", "date"])
    again = scaling.split_random(df.repartition(7), 0.2, ["symbol", "date"])[1]
    assert fit.count() + test.count() == 600 and 60 < test.count() < 180
    assert {(r.symbol, r.date) for r in test.collect()} == {(r.symbol, r.date) for r in again.collect()}


@pytest.mark.parametrize("series", [DAILY, CUT], ids=["whole", "cut"])
def test_broadcast_stat(spark, series):
    pdf = make_bars({"A": 40, "B": 2})
    out = by_series(asof.broadcast_stat(to_spark(spark, pdf), series=series))
    change = pdf.groupby("symbol")["close"].pct_change()
    assert close_to(out["volatility"], change.groupby(pdf["symbol"]).transform("std"))


def test_recent_samples_of_each_series(spark):
    df = spark.createDataFrame(
        [(k, i, i * 1.0) for k, n in (("a", 3000), ("b", 30), ("c", 4)) for i in range(n)], "k string, i int, close double")
    got = rows.recent_samples(df, 20, 5, series=Series("k", "i"))
    assert got.columns == df.columns
    held = {k: sorted(r.i for r in got.collect() if r.k == k) for k in "abc"}
    assert (len(set(held["a"])), len(set(held["b"])), held["c"]) == (5, 5, [])
    assert min(held["a"]) >= 2980 and min(held["b"]) >= 10
    assert held == {k: sorted(r.i for r in rows.recent_samples(df.repartition(7), 20, 5, series=Series("k", "i")).collect()
                              if r.k == k) for k in "abc"}
    plan = rows.recent_samples(df, 20, 5, series=Series("k", "i"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("Exchange hashpartitioning") == 1
    assert rows.recent_samples(df.limit(0), 20, 5, series=Series("k", "i")).count() == 0
