"""Operators for preparing training data; nothing else in the library imports them.

Functions that run in tasks are sent to the executors by value, so that those need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
