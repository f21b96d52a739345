"""Operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Tasks get this package's code by value, so executors need not have it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
