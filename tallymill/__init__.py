"""Spark DataFrame operators and named analytical queries.

Every operator takes lazy DataFrames and returns a lazy DataFrame; the few that
must look at the data first (fitted label lists, column choice, model training)
say so in their docstring and only ever bring bounded results to the driver.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel inside the tasks that call them, so executors need
# no copy of it on their Python path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
