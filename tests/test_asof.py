"""As-of joins against pandas, including ties, missing payloads and hot keys."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom.operators.asof import align_panel, asof_join, daily_calendar, enrich_asof


def dated(spark, pairs, name):
    return spark.createDataFrame([(date.fromisoformat(d), v) for d, v in pairs], f"date date, {name} double")


def test_calendar_plan_is_merge_asof(spark):
    left = make_bars({"A": 60, "B": 40})
    gdp = [("2000-01-15", 1.0), ("2000-02-10", None), ("2000-03-01", 3.0)]
    got = by_series(asof_join(to_spark(spark, left), dated(spark, gdp, "gdp")))
    right = pd.DataFrame(gdp, columns=["date", "gdp"]).assign(date=lambda d: pd.to_datetime(d["date"]))
    want = pd.merge_asof(
        left.assign(date=pd.to_datetime(left["date"])).sort_values("date", kind="stable"), right, on="date"
    ).sort_values(["symbol", "date"])
    assert close_to(got["gdp"], want["gdp"])


def test_rows_after_the_last_value_keep_it(spark):
    left = to_spark(spark, make_bars({"A": 50}))
    got = enrich_asof(left, [dated(spark, [("2000-01-02", 1.0)], "x"), dated(spark, [("2000-02-01", 2.0)], "y")])
    last = by_series(got).iloc[-1]
    assert (last["x"], last["y"]) == (1.0, 2.0)
    assert got.count() == 50


def test_calendar_is_broadcast_without_nested_loop(spark):
    left = to_spark(spark, make_bars({"A": 5}))
    plan = asof_join(left, dated(spark, [("2000-01-02", 1.0)], "x"))._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert daily_calendar([dated(spark, [("2000-01-01", 1.0), ("2000-01-05", 2.0)], "x")]).count() == 5


@pytest.fixture(scope="module")
def sides():
    rng = np.random.default_rng(3)
    start = datetime(2024, 1, 1)

    def make(n, name, hot):
        users = np.where(rng.uniform(size=n) < hot, 0, rng.integers(1, 9, n))
        ts = [start + timedelta(minutes=int(m)) for m in rng.integers(0, 1200, n)]
        return pd.DataFrame({"user": users, "ts": ts, name: rng.normal(size=n).round(3)})

    left = make(400, "x", 0.5)
    right = make(150, "y", 0.5).drop_duplicates(["user", "ts"])
    right.loc[right.index[::5], "y"] = np.nan
    return left, right


@pytest.mark.parametrize("bucket", [None, 60, (60, 7200)], ids=["checked", "narrow", "nested"])
@pytest.mark.parametrize("by", [["user"], []], ids=["keyed", "unkeyed"])
def test_point_plan_is_merge_asof(spark, sides, by, bucket):
    left, right = sides
    if not by:
        right = right.drop_duplicates("ts")[["ts", "y"]]
    right = right.assign(found=1.0)

    def load(pdf):
        def plain(v):
            if isinstance(v, pd.Timestamp):
                return v.to_pydatetime()
            return None if isinstance(v, float) and np.isnan(v) else v

        rows = [tuple(plain(v) for v in r)
                for r in pdf.astype(object).itertuples(index=False, name=None)]
        kinds = {"user": "bigint", "ts": "timestamp", "x": "double", "y": "double", "found": "double"}
        return spark.createDataFrame(rows, ", ".join(f"{c} {kinds[c]}" for c in pdf.columns))

    got = asof_join(load(left), load(right), on="ts", by=by, bucket=bucket).toPandas()
    want = pd.merge_asof(left.sort_values("ts"), right.sort_values("ts"), on="ts", by=by or None)
    order = ["user", "ts", "x"]
    got, want = (d.sort_values(order).reset_index(drop=True) for d in (got, want))
    assert close_to(got["found"], want["found"]) and close_to(got["y"], want["y"])
    assert (want["y"].isna() & want["found"].notna()).any()
    assert not by or want["found"].isna().any()


def test_panel(spark):
    df = spark.createDataFrame([("A", "m1", 1.0), ("B", "m2", 2.0)], "symbol string, month string, v double")
    rows = {r.month: (r.A, r.B, r.C) for r in align_panel(df, ["A", "B", "C"], "v").collect()}
    assert rows == {"m1": (1.0, None, None), "m2": (None, 2.0, None)}


def test_missing_days_match_nothing(spark):
    left = spark.createDataFrame([(1, None), (2, date(2000, 1, 5))], "i int, date date")
    for plan in (enrich_asof(left, [dated(spark, [("2000-01-02", 2.0)], "x")]),
                 asof_join(left.withColumn("k", F.lit(1)), dated(spark, [("2000-01-02", 2.0)], "x").withColumn("k", F.lit(1)), by=["k"])):
        assert {r.i: r.x for r in plan.collect()} == {1: None, 2: 2.0}


def test_clashing_names_get_suffixes(spark):
    left = spark.createDataFrame([(date(2000, 1, 5), 1.0)], "date date, close double")
    rights = [dated(spark, [("2000-01-02", 2.0)], "close"), dated(spark, [("2000-01-03", 3.0)], "close")]
    row = enrich_asof(left, rights, suffixes=["_q", "_d"]).first()
    assert (row.close, row.close_q, row.close_d) == (1.0, 2.0, 3.0)
    with pytest.raises(ValueError, match="clashing"):
        enrich_asof(left, rights, suffixes=["", "_d"])
