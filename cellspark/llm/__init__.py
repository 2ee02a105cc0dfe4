"""Operators for training-data pipelines over large text corpora.

Nothing outside this subpackage imports it.  The functions that run in Python workers are
pickled by value, so executors need only the third-party libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
