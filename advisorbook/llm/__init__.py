"""Operators of a training-data pipeline, their queries and SQL.

Functions that run in Python workers are pickled by value, so a cluster needs no copy of
this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
