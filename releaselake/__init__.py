"""Batch jobs over package-release data, written with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
