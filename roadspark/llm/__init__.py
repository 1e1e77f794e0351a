"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves, so they need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
