"""All registered checks."""

from checks import arma, fits, indicators, joins, models, moments, quantiles, summaries, tables, trading, wide  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
