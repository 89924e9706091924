"""Operators for preparing training text: one module per operator, plus the registered queries.

Nothing else in the library imports this subpackage. Functions that run in Python workers are
pickled by value, so executors need the third-party libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
