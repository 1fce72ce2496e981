"""A PySpark-native engine for mining bibliographic records and preparing document corpora."""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

# Functions of this package travel to the executors by value, so a worker needs no copy of the repository on its path.
register_pickle_by_value(sys.modules[__name__])
