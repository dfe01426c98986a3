"""Operators for building training data. Nothing outside this folder imports it."""

import sys

from pyspark import cloudpickle

# Executors get this code with the tasks, so that it need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
