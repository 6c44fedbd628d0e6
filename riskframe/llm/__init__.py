"""Corpus operators for training-data pipelines. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value: workers need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
