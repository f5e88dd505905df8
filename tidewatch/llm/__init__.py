"""Operators for preparing training text: formatting, filtering, deduplication, mixing and token output."""

import sys

from pyspark import cloudpickle

# Tasks get this code with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
