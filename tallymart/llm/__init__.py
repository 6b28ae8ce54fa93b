"""Operators of a training-data pipeline: dedup, quality, toxicity, language, mixing, packing.

Nothing outside this package imports it. Its functions travel to the executors by value, so
that workers need not find the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
