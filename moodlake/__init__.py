"""Text-sentiment analytics on Spark: collect, clean, score, summarise, cluster."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the task, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
