"""Operators for training-data pipelines over documents and web pages."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job itself, so the
# package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
