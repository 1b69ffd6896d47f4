"""Operators of a training-data pipeline. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors whole, which then need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
