"""Operators for training-data pipelines.

Tasks get the package's functions by value, so that executors need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
