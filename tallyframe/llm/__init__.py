"""Operators for preparing training text; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# tasks get this folder's functions by value, so executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
