"""Auditable log, knowledge-base and extraction analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with their tasks, so executors need neither
# an installed copy of this package nor its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
