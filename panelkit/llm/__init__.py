"""Operators for preparing training text; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with the job, so executors need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
