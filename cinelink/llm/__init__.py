"""Operators that prepare text for the training of language models. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions sent to executors take their helpers along, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
