"""Operators of a training-data pipeline: mixing, quality, deduplication, packing, search, sharding.

Nothing else in the library imports this subpackage; it imports nothing of the rest.
"""

import sys

from pyspark import cloudpickle

# The functions that tasks run travel with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
