"""Weftline: relational, text, table, cell and streaming jobs written as plain Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
