"""Operators for preparing training data, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with their code, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
