"""Operators of a training-data pipeline: cleaning, deduplication, search, mixing and tokens.

Functions that run inside Spark's Python workers are shipped by value, so executors need
no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
