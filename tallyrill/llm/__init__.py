"""Operators for preparing language-model training data, and their registered queries."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so the workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
