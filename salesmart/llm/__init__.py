"""Operators for preparing training data; nothing else in the library imports this package.

Functions that run in Python workers travel with the job by value, so
executors need no copy of this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
