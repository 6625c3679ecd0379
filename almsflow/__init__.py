"""Spark-native pipeline: nonprofit filings -> tables -> recipient resolution -> recommendations."""

import sys

from pyspark import cloudpickle

# Ship the functions that run inside tasks by value, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
