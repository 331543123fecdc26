"""Operators for large training-data pipelines. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the query, so workers need no installation of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
