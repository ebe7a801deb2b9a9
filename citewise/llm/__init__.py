"""Operators of a training-data pipeline. Nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Ship the code that runs in tasks with the tasks: executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
