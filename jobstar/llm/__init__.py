"""Training-data operators: deduplication, decontamination, mixing, sharding, scans.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with them, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
