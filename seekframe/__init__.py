"""Batch retrieval over DataFrames: corpora in, ranked hits and prompts out."""

import sys

from pyspark import cloudpickle

# The few functions that run inside Python workers travel with the job, so executors
# need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
