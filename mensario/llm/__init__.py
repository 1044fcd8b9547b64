"""Operators for training-data corpora. Nothing else in the library imports this package.

Functions that run in Python workers are shipped by value, so that executors need not
have the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
