"""voxloom: speech-corpus curation and transcript scoring as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python workers need not have this package installed: its functions travel with the query.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
