"""Operators for text corpora: one module each, all on DataFrames.

Task code of this package travels to the executors by value, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
