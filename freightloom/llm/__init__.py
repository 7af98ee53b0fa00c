"""Operators for training corpora, each a function from DataFrames to DataFrames.

The modules travel to the executors by value, so that a worker needs no
installed copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
