"""Training-data preparation and evaluation as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers by value, so only the driver has to have it
# installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
