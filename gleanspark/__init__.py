"""gleanspark: a Spark-native engine that turns logged model traffic and raw text into training data.

Functions of this package travel to executors by value, so workers need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
