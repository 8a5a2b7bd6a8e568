"""Typed scans of price bars, dated series and vendor JSON."""

from tickloom.sources.files import read_bars_csv, read_bars_dir, read_series_csv
from tickloom.sources.landed import parse_bar_envelope, price_history
from tickloom.sources.vendor import read_vendor_folder

__all__ = [
    "parse_bar_envelope", "price_history", "read_bars_csv", "read_bars_dir", "read_series_csv",
    "read_vendor_folder",
]
