"""Operators of a training-data pipeline; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel by value, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
