"""Operators of a training-data pipeline; nothing else in the library imports them.

The package is pickled by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
