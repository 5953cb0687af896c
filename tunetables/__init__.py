"""Spark tables for language-model tuning: training sets, scores, run logs.

Everything here takes and returns Spark DataFrames.  Functions that run inside
Python workers are pickled by value, so a job submitted with only the driver's
copy of this package still finds them on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
