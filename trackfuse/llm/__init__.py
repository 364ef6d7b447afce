"""Operators for the making of training corpora; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# The functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
