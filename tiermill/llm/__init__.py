"""Operators of a training-data pipeline: quality, toxicity, de-duplication, packing, search, extraction, mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with the task, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
