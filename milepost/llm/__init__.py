"""Operators of a training-data pipeline; their queries are in ``queries``."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
