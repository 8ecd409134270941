"""Set-wise steps: DataFrames in, DataFrames out."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
