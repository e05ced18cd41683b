"""Operators of a training-data pipeline; the rest of the package does not import this folder."""

import sys

from pyspark import cloudpickle

# functions of this folder travel to the executors by value, so that those need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
