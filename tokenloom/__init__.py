"""Byte-level BPE tokenization and token-data operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel to the tasks by value, so executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
