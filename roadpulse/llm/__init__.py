"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors by value; they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
