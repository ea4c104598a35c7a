"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the query, so that the
# package needs to be installed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
