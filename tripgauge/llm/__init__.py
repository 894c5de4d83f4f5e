"""Operators for building training data: mixing, deduplication, extraction, scoring, encoding.

The functions that run in Python workers travel with the job, so that a cluster needs the public
libraries only and no copy of this package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
