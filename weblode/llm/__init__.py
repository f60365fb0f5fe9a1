"""Operators a large-scale training-data pipeline needs. Nothing else in the library imports this package.

The code of this package travels to the Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
