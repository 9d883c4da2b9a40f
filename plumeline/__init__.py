"""plumeline: exposure-association analytics expressed as Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors with their code, so that a cluster
# needs nothing installed beside PySpark, NumPy and PyArrow.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
