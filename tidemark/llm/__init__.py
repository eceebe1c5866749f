"""Operators for preparing training text; nothing else in the library imports them.

Functions of this package that run in Python workers are sent by value, so executors
need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
