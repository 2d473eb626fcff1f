"""Operators for large-scale preparation of language-model training data."""

import sys

from pyspark import cloudpickle

# Tasks get these functions with their job, wherever the package is installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
