"""Operators for preparing training text at scale.

The functions that run in Python workers are pickled by value, so executors need
the libraries these modules import, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
