"""Corpus operators for training data.

Functions that run inside Python tasks are pickled by value, so executors need
no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
