"""Operators for preparing training text at scale, one module each.

Nothing else in the package imports this folder. Functions that run in tasks travel
with the job by value, as those of the parent package do.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
