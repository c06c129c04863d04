"""mdquarry: a Spark-native engine that turns markdown corpora into
question/answer training datasets.

Every stage is a ``DataFrame -> DataFrame`` function built from Spark SQL
column expressions, joins, aggregations and windows; the only Python that
runs inside tasks is the Arrow-batched similarity kernel
(:mod:`mdquarry.operators.neighbours`) and the pluggable responder hook
(:mod:`mdquarry.operators.responses`).

Functions that run inside Python workers are pickled by value, so a job also
works where the workers cannot import this package (no ``--py-files`` needed).
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["session"]
