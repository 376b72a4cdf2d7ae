"""Operators for large training-data corpora.

Every module holds one operator with its own interface; ``queries`` wraps
each in the thin ``opN_<name>`` query. Functions that run inside Python tasks
are pickled by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
