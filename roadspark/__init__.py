"""Road-demand analytics on Spark: profiling, features, models and marts."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves, so they need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
