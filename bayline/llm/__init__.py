"""Operators for preparing language-model training data.

Functions of this package that run in Spark's Python workers travel with the tasks, so that
executors need no copy of the repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
