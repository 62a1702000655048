"""kinelake: auditable robot-trajectory data on Spark DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers get the package's functions with each task, so executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
