"""Kept scales: merging, unseen groups, constants and empty tables."""

import numpy as np
import pytest

from tests.frames import by_series, close_to, make_bars, to_spark
from tickloom.operators.moments import fit_moments, merge_moments, scale_by


def test_merged_fits_and_rules(spark):
    pdf = make_bars({"A": 60, "B": 30, "C": 1}, gaps=0.2)
    pdf["close"] += 1e9  # a level far from zero
    df = to_spark(spark, pdf)
    parts = [df.where(f"pmod(hash(date), 3) = {i}") for i in range(3)] + [df.limit(0)]
    merged = merge_moments([fit_moments(p, ["close", "volume"], ["symbol"]) for p in parts], ["symbol"])
    rows = {(r["symbol"], r["column"]): r for r in merged.collect()}
    for symbol, part in pdf.groupby("symbol"):
        for c in ("close", "volume"):
            x, r = part[c].dropna(), rows[symbol, c]
            assert r["n"] == len(x)
            if len(x):
                assert close_to([r["mean"], r["lowest"], r["highest"]], [x.mean(), x.min(), x.max()], 1e-12)
                assert np.sqrt(r["m2"] / r["n"]) == pytest.approx(x.std(ddof=0), rel=1e-5, abs=1e-6)
    seen = merged.where("symbol = 'A'")
    a = pdf[pdf["symbol"] == "A"]["volume"]
    for kind, low, width in (("standard", a.mean(), a.std(ddof=0)), ("minmax", a.min(), a.max() - a.min())):
        out = by_series(scale_by(df, seen, ["volume"], ["symbol"], kind))
        want = pdf.sort_values(["symbol", "date"])["volume"]
        assert close_to(out["volume"], (want - low) / width)  # B and C are unseen: by all, which is A
        out = by_series(scale_by(df, seen, ["volume"], ["symbol"], kind, "null"))
        assert out[out["symbol"] != "A"]["volume"].isna().all() and out[out["symbol"] == "A"]["volume"].notna().all()
    flat = spark.createDataFrame([("A", 5.0), ("A", 5.0)], "symbol string, volume double")
    assert [r["volume"] for r in scale_by(flat, fit_moments(flat, ["volume"]), ["volume"]).collect()] == [0.0, 0.0]
    with pytest.raises(ValueError):
        scale_by(df, seen, ["volume"], kind="other")
