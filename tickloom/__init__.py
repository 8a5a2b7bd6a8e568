"""Market analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tickloom.plans import DAILY, Feature, Running, Series, with_features, with_running

# Functions run by Python workers travel with the query: executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DAILY", "Feature", "Running", "Series", "with_features", "with_running"]
__version__ = "0.1.0"
