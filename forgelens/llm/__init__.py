"""Operators for training-data pipelines. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with the task; they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
