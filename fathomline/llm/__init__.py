"""Operators of a training-data pipeline: cleaning, scoring, deduplication, packing.

Nothing else in the library imports this package. Functions that run in Python workers travel by value, so executors
need the third-party libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
