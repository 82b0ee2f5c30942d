"""Text-simplification corpora and their evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so executors do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
