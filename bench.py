"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
Each query runs once after a warm-up query; its whole result is computed and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.suite import QUERIES  # noqa: E402

HEADLINE = [
    "read_bars_csv", "parse_bar_envelope", "price_history", "slice_rows",
    "asof_join", "asof_join_keyed", "asof_join_unkeyed", "enrich_asof", "align_panel",
    "stock_features", "latest_levels", "majority_vote", "rolling_mean", "ema", "expanding_features",
    "rsi_wilder", "macd_ta", "ichimoku", "adx", "cci", "psar",
    "feature_set_hand", "feature_set_ta", "feature_set_trader", "feature_set_tft",
    "tick_rolling_mean", "tick_ema", "standardize", "group_normalize", "forecast_samples",
    "future_frame", "ar_forecast", "backtest", "equity_curve", "compare_strategies",
    "buy_classifier", "pca", "kmeans_vectors", "sentiment_classify", "token_window",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    names = sys.argv[1:] or HEADLINE
    QUERIES["project"](spark, folder).write.format("noop").mode("overwrite").save()
    took: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(took.values()), 3),
        "unit": "sec", "queries": took, "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()
