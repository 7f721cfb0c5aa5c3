"""Training-data operators: dedup, packing, archives, filters, tokenising."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's code with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
