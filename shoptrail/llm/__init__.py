"""Operators for preparing training data. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Python tasks carry this subpackage's functions with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
