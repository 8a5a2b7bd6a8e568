"""A sample of the registered queries against their SQL at the smallest scale, and plan shapes."""

import os
import re

import pytest

import __spark_entry__ as driver
from checks.compare import database, difference
from checks.views import bars, ticks
from tickloom import Series, with_features
from tickloom.functions import window as win
from tickloom.operators.features import hand

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
SAMPLE = [
    "rolling_mean", "macd_ta", "adx", "psar", "asof_join_keyed", "enrich_asof", "stock_features",
    "compare_strategies", "ar_forecast", "forecast_samples", "token_window", "price_history",
    "tick_ema", "standardize", "tile",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    got = driver.queries()[name](spark, SMALL).toPandas()
    want = database(SMALL).execute(driver.oracle_sql()[name]).fetchdf()
    assert difference(got, want) is None


def test_every_oracle_has_a_query(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() == 25


def test_one_exchange_for_all_indicators(spark):
    plan = hand(bars(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("== Initial Plan ==")[-1]
    keyed = re.findall(r"Exchange hashpartitioning\(p_brand#\d+, 4\)", initial)
    assert len(keyed) <= 1 and "symbol" not in "".join(re.findall(r"Exchange hash.*", initial)[1:])


def test_ticks_are_cut(spark):
    out = with_features(ticks(spark, SMALL), win.rolling_mean("value", 3), series=Series("user_id", "ts"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    groups = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan.split("== Initial Plan ==")[-1])
    assert any("_chunk" in g for g in groups) and any("_bucket" in g for g in groups)
    assert "ReadSchema" in plan and "event_type" not in re.search(r"ReadSchema: (.*)", plan).group(1)
