"""Spark-native analytics over recorded speech: intervals, lines, vectors and signals.

Every operator is a function ``DataFrame -> DataFrame`` usable with ``df.transform``.
"""

import sys

from pyspark import cloudpickle

# Python functions of this package travel to executors by value, so that a
# cluster needs no copy of the package on its workers' import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
