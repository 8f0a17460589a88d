"""Multilingual figurative-phrase data on Spark: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# The code of a task travels with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
