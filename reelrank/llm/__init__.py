"""Operators of a training-data pipeline: one module per operator, and their queries."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
