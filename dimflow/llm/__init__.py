"""Operators of a training-data pipeline: extraction, filtering, deduplication, formatting, mixing."""

import sys

from pyspark import cloudpickle

# Task functions travel with their jobs, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
