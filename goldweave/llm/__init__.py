"""Operators for preparing training data: one module per operator, the stages
of the corpus pipeline on top of them. Nothing else in the library imports
this subpackage."""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to the executors by value, so that it
# need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])
