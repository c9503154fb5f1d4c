"""Operators of a training-data pipeline: deduplication, filtering, scoring, mixing.

Nothing else in the library imports this subpackage. Functions that run in
Python workers travel by value, so executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
