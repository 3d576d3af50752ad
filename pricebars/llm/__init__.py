"""Operators for preparing training data at scale, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their tasks, which need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
