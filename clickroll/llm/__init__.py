"""Operators for training data, and the queries that apply them to whole tables."""

import sys

from pyspark import cloudpickle

# Tasks get the functions themselves, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
