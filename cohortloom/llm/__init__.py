"""Operators for training-data pipelines: one module per operator, queries in ``queries``.

Functions that run inside tasks are pickled by value, so executors need the
Python libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
