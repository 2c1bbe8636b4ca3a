"""Spark-native loading and refreshing of warehouse tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
