"""Retail sales panel analytics and many-series forecasting on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the plan; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
