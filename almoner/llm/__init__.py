"""Operators for preparing training text: sharding, packing, extraction, near duplicates, filters, mixing, formatting."""

import sys

from pyspark import cloudpickle

# functions that run inside tasks travel with them: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
