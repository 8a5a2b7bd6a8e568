"""Samples in shared blocks, future rows in every kind of order, and files under their own headers."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom import Series
from tickloom.operators import forecast, rows
from tickloom.sources import read_bars_csv

CUT = Series(chunk_rows=11, bucket=20)


@pytest.mark.parametrize("series", [Series(), CUT], ids=["whole", "cut"])
def test_blocks_hold_the_same_samples(spark, series):
    def load():
        return lambda back, ahead: (len(back), back[0, 0], back[-1, 1], ahead.sum(), len(ahead))

    df = rows.row_index(to_spark(spark, make_bars({"A": 70, "B": 1, "C": 9}, gaps=0.1)))
    blocks = forecast.sample_blocks(df, ["time_idx"], ["close", "volume"], 8, 4, 3, 2, series)
    held = blocks.select("symbol", F.explode("rows").alias("r")).groupBy("symbol", "r.time_idx").count()
    assert held.agg(F.max("count")).first()[0] <= 2 and held.count() == 80
    out = "n int, first double, last double, total double, m int"
    got = by_series(forecast.read_samples(blocks, load, ["close", "volume"], ["close"], out, series))
    want = by_series(forecast.forecast_samples(df, ["time_idx"], ["close", "volume"], 8, 4, 3, 2))
    assert list(got["symbol"]) == list(want["symbol"]) and list(got["date"]) == list(want["date"])
    assert list(got["n"]) == list(want["encoder_length"]) and list(got["m"]) == [len(d) for d in want["decoder"]]
    assert close_to(got["first"], [np.nan if e[0]["close"] is None else e[0]["close"] for e in want["encoder"]])
    assert close_to(got["last"], [e[-1]["volume"] for e in want["encoder"]])
    totals = [sum(np.nan if x["close"] is None else x["close"] for x in d) for d in want["decoder"]]
    assert close_to(got["total"], totals)
    assert forecast.read_samples(forecast.sample_blocks(df.limit(0), [], ["close"]), load, ["close"], ["close"], out).collect() == []


@pytest.mark.parametrize("series", [Series("k", "at"), Series("k", "at", chunk_rows=None)], ids=["cut", "whole"])
def test_future_keeps_the_step_of_the_order(spark, series):
    start = datetime(2024, 1, 1, 9, 30)
    data = [("a", start + timedelta(hours=i), i, float(i)) for i in range(5)] + [("b", start, 0, 7.0)]
    df = spark.createDataFrame(data, "k string, at timestamp, time_idx int, v double")
    for kind in ("timestamp", "timestamp_ntz"):
        out = forecast.future_frame(df.withColumn("at", F.col("at").cast(kind)), 3, series=series).orderBy("k", "time_idx").collect()
        assert [r["at"] for r in out if r["k"] == "a"] == [start + timedelta(hours=i) for i in range(8)]
        assert [r["v"] for r in out if r["k"] == "a"] == [0, 1, 2, 3, 4, 2, 3, 4]
        assert [(r["at"], r["v"]) for r in out if r["k"] == "b"] == [(start, 7.0), (start + timedelta(days=1), 7.0)]
    placed = df.withColumn("at", F.col("time_idx").cast("bigint") * 10)
    out = forecast.future_frame(placed, 2, series=series).where("k = 'a'").orderBy("time_idx").collect()
    assert [r["at"] for r in out] == [0, 10, 20, 30, 40, 41, 42]


def test_each_path_under_its_own_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Date,High,Low,Close,Volume\n2020-01-02,3,1,2,10\n")
    (tmp_path / "b.csv").write_text("volume,close,low,high,date\n20,5,4,6,2020-01-03\n")
    out = read_bars_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], "S").orderBy("date").collect()
    assert [(r["symbol"], r["high"], r["low"], r["close"], r["volume"]) for r in out] == [("S", 3, 1, 2, 10), ("S", 6, 4, 5, 20)]
    (tmp_path / "c.csv").write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        read_bars_csv(spark, [str(tmp_path / "c.csv")])
