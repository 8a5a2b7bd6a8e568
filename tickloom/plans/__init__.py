"""Physical layout of series work: running scans, halo frames, scratch folders."""

from tickloom.plans.frames import Carried, Feature, with_features
from tickloom.plans.running import Running, with_running
from tickloom.plans.series import DAILY, Series

__all__ = ["Carried", "DAILY", "Feature", "Running", "Series", "with_features", "with_running"]
