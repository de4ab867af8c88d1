"""Operators for preparing large text corpora: filtering, near-duplicates, privacy,
token counts, packing, scoring and vector search. Nothing else in the package
imports this subpackage.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this subpackage travel to the executors by value, so that a cluster
# needs no copy of the package on its machines.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
