"""Operators of a training-data pipeline, each by one named method, as Spark jobs.

Task code of this package is pickled by value: a cluster needs no copy of it on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
