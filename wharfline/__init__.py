"""Data-product exchange between organisations, expressed as Spark DataFrame jobs."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
