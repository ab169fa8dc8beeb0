"""Operators for preparing training text: tokens, search, joins, scans, files, packing and selection."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
